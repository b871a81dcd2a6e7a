"""Event rows used by several tests: a song and a search event in the columns of EVENT_SCHEMA."""


def song(ts, eid, user="1", playlist="ChillHits", device="Desktop", songid="x"):
    return (eid, user, ts, "SongEvent", "EndSong", device, playlist, songid)


def search(ts, eid, user="1", device="Desktop", event_type="SearchSong"):
    return (eid, user, ts, "SearchEvent", event_type, device, None, None)
