"""Job control: what is left to do, bounded retries, a run lock."""

from __future__ import annotations

import json
import os
import threading
from collections.abc import Callable
from contextlib import contextmanager, suppress

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.records import completed


def work_queue(files: DataFrame, lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents, zips) without a final line in the checkpoint."""
    left = files.join(completed(lines), "arquivo", "left_anti")
    return left.filter("tipo <> 'zip'"), left.filter("tipo = 'zip'")


def with_retries(queue: DataFrame, run: Callable[[DataFrame], DataFrame], most: int = 2, keep: Callable[[DataFrame], DataFrame] = lambda d: d) -> DataFrame:
    """Records of ``queue``: failed documents that may be tried again run up to ``most`` more times.

    Every round works on the failing rest only; ``keep`` makes a round's records durable.
    """
    done, left, attempt = None, queue, 1
    while True:
        records = keep(run(left).withColumn("tentativas", F.lit(attempt)))
        again = (F.col("status") == "erro") & F.col("retentavel")
        final = records if attempt > most else records.filter(~again)
        done = final if done is None else done.unionByName(final)
        if attempt > most:
            return done
        left = queue.join(records.filter(again).select("arquivo"), "arquivo", "left_semi")
        if left.isEmpty():
            return done
        attempt += 1


def run_metadata(files: DataFrame, lines: DataFrame, expanded: DataFrame, processed: int) -> dict:
    got = expanded.agg(F.count_if(F.col("erro").isNull() & ~F.col("existed")).alias("zips"), F.coalesce(F.sum("files"), F.lit(0)).alias("members")).first()
    return {"encontrados": files.count(), "zips_expandidos": got.zips, "arquivos_extraidos": got.members, "retomados": completed(lines).count(), "processados": processed}


def started_at(pid: int) -> str | None:
    """When a process began, as the kernel counts it; None where that isn't known. Tells a pid from its successor."""
    try:
        with open(f"/proc/{pid}/stat", encoding="utf-8", errors="replace") as f:
            return f.read().rpartition(")")[2].split()[19]
    except (OSError, IndexError):
        return None


@contextmanager
def run_lock(path: str):
    """A lock file with the owner's pid and its start; one left by a process that is gone is taken over."""
    for _ in range(2):
        try:
            fd = os.open(path, os.O_CREAT | os.O_EXCL | os.O_WRONLY)
            break
        except FileExistsError:
            try:
                with open(path, encoding="utf-8") as f:
                    held = json.load(f)
                os.kill(int(held["pid"]), 0)
                if held.get("inicio") not in (None, started_at(int(held["pid"]))):
                    raise ValueError("the pid belongs to another process by now")
            except (OSError, ValueError, KeyError, TypeError):
                with suppress(FileNotFoundError):
                    os.unlink(path)
                continue
            raise RuntimeError(f"another run holds {path}") from None
    else:
        raise RuntimeError(f"{path} can't be taken")
    with os.fdopen(fd, "w") as f:
        json.dump({"pid": os.getpid(), "inicio": started_at(os.getpid())}, f)
    try:
        yield
    finally:
        os.unlink(path)


class Sampler:
    """Samples this machine's load and this process's memory every ``seconds``, for ``resource_summary``."""

    def __init__(self, seconds: float = 2.0):
        self._seconds, self._stop, self.samples = seconds, threading.Event(), []

    def __enter__(self) -> Sampler:
        import psutil

        def sample():
            own = psutil.Process()
            psutil.cpu_percent()
            while not self._stop.wait(self._seconds):
                self.samples.append((psutil.cpu_percent(), psutil.virtual_memory().percent, own.memory_info().rss / 2**20))

        self._thread = threading.Thread(target=sample, daemon=True)
        self._thread.start()
        return self

    def __exit__(self, *_) -> None:
        self._stop.set()
        self._thread.join()

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.samples, "cpu double, ram double, rss double")


def progress(spark: SparkSession) -> dict[str, int]:
    """Tasks of the running stages: all, active, done and failed."""
    tracker = spark.sparkContext.statusTracker()
    infos = [i for s in tracker.getActiveStageIds() if (i := tracker.getStageInfo(s))]
    return {"tarefas": sum(i.numTasks for i in infos), "ativas": sum(i.numActiveTasks for i in infos), "prontas": sum(i.numCompletedTasks for i in infos), "falhas": sum(i.numFailedTasks for i in infos)}
