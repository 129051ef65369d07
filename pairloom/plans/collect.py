"""Stage 1: land each source as a raw table."""

from __future__ import annotations

import logging
from collections import Counter
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from pairloom.session import shuffles_deleted
from pairloom.sources.readers import read_json_records, scan
from pairloom.sources.writers import write_raw

log = logging.getLogger(__name__)

AT_ONCE = 4


@dataclass(frozen=True)
class Source:
    """Where a dataset is, and how its columns become those of the raw table.

    With ``layout``, one of ``read_json_records``, ``resolve`` is given JSON records as they are (``part, pos, v,
    raw``) instead of columns of an inferred schema; ``resolve_records`` takes those.
    """

    name: str
    path: str
    resolve: Callable[[DataFrame], DataFrame]
    fmt: str = "parquet"
    options: dict[str, str] = field(default_factory=dict)
    layout: str | None = None

    def rows(self, spark: SparkSession) -> DataFrame:
        if self.layout is not None:
            return self.resolve(read_json_records(spark, self.path, self.layout, raw=True))
        return self.resolve(scan(spark, self.path, self.fmt, **self.options))


def collect(
    spark: SparkSession,
    sources: Sequence[Source],
    folder: str,
    fmt: str = "parquet",
    versioned: bool = False,
    at_once: int = AT_ONCE,
) -> DataFrame:
    """Writes ``folder/<name>`` per source and returns ``source, status, n_rows``, in the given order.

    An error in one source is logged and does not stop the others. Up to ``at_once`` sources run side by side, each
    in a scheduler pool of its own, so that with ``spark.scheduler.mode=FAIR`` a large one leaves the others
    their share of the cores; without, its tasks go first but the others still fill what they leave free. The raw
    tables keep ``part`` and ``pos``, as the names of the written files do not give the order. ``versioned`` as in
    ``write_raw``.
    """
    twice = [name for name, n in Counter(source.name for source in sources).items() if n > 1]
    if twice:
        raise ValueError(f"several sources are named {twice[0]!r}")

    def run(source: Source) -> tuple[str, str, int]:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"collect-{source.name}")
        try:
            return source.name, "saved", write_raw(source.rows(spark), f"{folder}/{source.name}", fmt, versioned)
        except Exception as error:  # whatever goes wrong with one source
            reason = str(error).partition("\n")[0]
            log.warning("source %s failed: %s: %s", source.name, type(error).__name__, reason)
            return source.name, "failed", 0

    # Set for all sources at once, as they share the session.
    with shuffles_deleted(spark), ThreadPoolExecutor(max(1, min(at_once, len(sources)))) as pool:
        # Each source gets a copy of this thread's local properties, such as a job group.
        running = [pool.submit(inheritable_thread_target(spark)(run), source) for source in sources]
        outcome = [source.result() for source in running]
    return spark.createDataFrame(outcome, "source string, status string, n_rows bigint")
