"""Command-line entry points (files instead of Kafka)."""

import os
import subprocess
import sys

from cadence.__main__ import _parser, options_from

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_flags_map_to_options():
    args = _parser().parse_args(["analyze", "broker:9092", "--session-gap", "30", "--no-discover-weekly", "--dialect", "span"])
    o = options_from(args)
    assert (o.session_gap_s, o.discover_weekly, o.subsession_stats, o.dialect, o.panes) == (30, False, True, "span", False)
    assert options_from(_parser().parse_args(["analyze"])).panes is True
    legacy = options_from(_parser().parse_args(["analyze", "kafka:9092", "--nodiscover-weekly", "--nosession-stats"]))
    assert (legacy.discover_weekly, legacy.session_stats, legacy.subsession_stats) == (False, False, True)


def test_generate_then_analyze_files(tmp_path):
    env = dict(os.environ, PYTHONPATH=REPO)
    events = str(tmp_path / "events")
    subprocess.run(
        [sys.executable, "-m", "cadence", "generate", "--count", "300", "--sink-format", "parquet", "--path", events],
        check=True, env=env, cwd=str(tmp_path), timeout=600, capture_output=True,
    )
    out = str(tmp_path / "out")
    subprocess.run(
        [sys.executable, "-m", "cadence", "analyze", "--source-format", "parquet", "--source-path", events,
         "--sink-format", "parquet", "--output", out, "--dialect", "span", "--available-now"],
        check=True, env=env, cwd=str(tmp_path), timeout=600, capture_output=True,
    )
    # No sentinel follows the data, so only sessions the watermark has already closed
    # are written: those of users silent for more than one gap before the last event.
    import glob

    import pyarrow.parquet as pq

    for name, prefix in (("session_stats", "User "), ("discover_weekly", "UserId "), ("subsessions", "UserId ")):
        files = glob.glob(os.path.join(out, name, "batch=*", "*.parquet"))
        values = [v for f in files for v in pq.read_table(f).column("value").to_pylist()]
        assert values and all(v.startswith(prefix) for v in values), name


def test_batch_analyze_files(tmp_path):
    env = dict(os.environ, PYTHONPATH=REPO)
    events = str(tmp_path / "events")
    subprocess.run(
        [sys.executable, "-m", "cadence", "generate", "--count", "200", "--sink-format", "parquet", "--path", events],
        check=True, env=env, cwd=str(tmp_path), timeout=600, capture_output=True,
    )
    out = str(tmp_path / "out")
    subprocess.run(
        [sys.executable, "-m", "cadence", "analyze", "--batch", "--source-format", "parquet", "--source-path", events,
         "--output", out],
        check=True, env=env, cwd=str(tmp_path), timeout=600, capture_output=True,
    )
    import pyarrow.parquet as pq

    panes = pq.read_table(os.path.join(out, "session_panes")).column("value").to_pylist()
    stats = pq.read_table(os.path.join(out, "session_stats")).column("value").to_pylist()
    assert stats and all(v.startswith("User: ") for v in stats)
    assert len(panes) >= len(stats)
    assert os.path.isdir(os.path.join(out, "discover_weekly")) and os.path.isdir(os.path.join(out, "subsessions"))


def test_driver_style_run_outside_the_repo(tmp_path):
    """As the driver runs us: a plain session, another working directory, the repo only
    on the driver's sys.path.  Stateful stream operators must still reach their workers."""
    script = tmp_path / "drv.py"
    script.write_text(
        "import sys\n"
        f"sys.path.insert(0, {REPO!r})\n"
        "from pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.master('local[4]').config('spark.ui.enabled', 'false')"
        ".config('spark.sql.shuffle.partitions', '4').getOrCreate()\n"
        "import __spark_entry__ as E\n"
        "print('ENTRY', E.entry(spark).count())\n"
        "for name in ('stream_incremental_listening_runs', 'stream_early_panes_final'):\n"
        "    print('ROWS', name, E.queries()[name](spark, '/root/testdata/sf0.001').count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    res = subprocess.run([sys.executable, str(script)], cwd=str(tmp_path), env=env, timeout=900, capture_output=True, text=True)
    assert res.returncode == 0, res.stderr[-3000:]
    lines = [line for line in res.stdout.splitlines() if line.startswith(("ENTRY", "ROWS"))]
    assert len(lines) == 3 and all(int(line.split()[-1]) > 0 for line in lines), res.stdout[-2000:]
