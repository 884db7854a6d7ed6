import threading

import psutil
from pyspark.sql import functions as F

from ledgerloom.plans import landing


def python_peak(work):
    """The most MB that this process's Python workers held at once while ``work`` ran."""
    peak, ended = [0.0], threading.Event()

    def held(p):
        try:
            return p.memory_full_info().pss / 1e6 if "python" in p.name() else 0.0
        except psutil.Error:
            return 0.0

    def watch():
        while not ended.wait(0.05):
            peak[0] = max(peak[0], sum(map(held, psutil.Process().children(recursive=True))))

    watcher = threading.Thread(target=watch)
    watcher.start()
    try:
        work()
    finally:
        ended.set()
        watcher.join()
    return peak[0]


def test_many_files_of_a_task_are_not_held_together(spark, tmp_path):
    def files(n):
        name = F.format_string("a/%03d.txt", "id")
        return spark.range(0, n, 1, 1).select(name.alias("name"), F.encode(F.repeat(F.lit("line\n"), 200_000), "UTF-8").alias("content"))

    few = python_peak(lambda: landing.land(files(20), f"file:{tmp_path}/few"))
    many = python_peak(lambda: landing.land(files(400), f"file:{tmp_path}/many"))
    assert many < few + 60  # MB; the files have 400
    written = sorted((tmp_path / "many" / "a").iterdir())
    assert [f.name for f in written] == [f"{i:03d}.txt" for i in range(400)]
    assert all(f.stat().st_size == 1_000_000 for f in written)
    assert written[7].read_bytes() == b"line\n" * 200_000
