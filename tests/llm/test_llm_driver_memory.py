"""Memory of the driver between the steps of a long job."""

import re
from pathlib import Path

from recordsync.llm import common


def held(spark) -> int:
    """MB of the driver's JVM in memory."""
    pid = spark._jvm.java.lang.ProcessHandle.current().pid()
    return int(re.search(r"\nVmRSS:\s+(\d+)", Path(f"/proc/{pid}/status").read_text())[1]) >> 10


def test_release_returns_what_is_free_outside_the_heap(spark):
    made = [spark._jvm.java.util.zip.Deflater() for _ in range(800)]  # some 250 kB each, outside the heap
    for x in made[:-1]:
        x.end()  # the last one stays, so that the C library can't shorten its pool by itself
    for _ in range(2):
        spark._jvm.System.gc()
    before = held(spark)
    common.release(spark)
    after = held(spark)
    made[-1].end()
    assert before - after > 50


def test_release_without_the_command(spark, monkeypatch):
    monkeypatch.setattr(common, "TRIM", ("com.sun.management:type=DiagnosticCommand", "noSuchCommand"))
    common.release(spark)
    assert spark.range(3).count() == 3
