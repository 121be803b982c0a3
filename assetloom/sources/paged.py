"""A paged service as a Spark data source: one task per (query, time window) follows its cursor.

The same service is a streaming source where a ``peek`` can name the page after a page: the offset is
the cursor of the last page read of each chain, and tasks fetch the pages between two offsets.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

# fetch(query, since, until, cursor, page_size) -> (rows, next cursor or None); rows are tuples or an
# Arrow table, which Spark takes over without a Python object per row.
Fetch = Callable[[str, str | None, str | None, str | None, int], tuple[list[tuple] | pa.Table, str | None]]


# peek(query, since, until, cursor) -> cursor of the page after that of ``cursor`` (None: the first), or None.
Peek = Callable[[str, str | None, str | None, str | None], str | None]

#: The offset of a chain whose first page, which has no cursor, is the last one read.
FIRST_PAGE = ""


@dataclass
class Chain(InputPartition):
    """One cursor chain: a query within a half-open time window."""

    query: str
    since: str | None = None
    until: str | None = None


@dataclass
class Stretch(InputPartition):
    """The pages of a chain after page ``start`` (None: from the first on) up to page ``end``."""

    chain: Chain
    start: str | None
    end: str


def split_window(query: str, start: dt.datetime, end: dt.datetime, step: dt.timedelta) -> list[Chain]:
    """Chains over consecutive windows, so one long query is read by many tasks."""
    out, at = [], start
    while at < end:
        upto = min(at + step, end)
        out.append(Chain(query, at.isoformat(), upto.isoformat()))
        at = upto
    return out


def follow(fetch: Fetch, chain: Chain, page_size: int, limit: int | None) -> Iterator:
    """Rows of a chain, page by page, until there is no next cursor or the limit is reached."""
    cursor, left = None, limit
    while left is None or left > 0:
        rows, cursor = fetch(chain.query, chain.since, chain.until, cursor, page_size)
        page = rows if left is None else rows[:left]
        yield from page.to_batches() if isinstance(page, pa.Table) else page
        if left is not None:
            left -= len(page)
        if not cursor:
            return


def last_page(peek: Peek, chain: Chain, at: str | None) -> str:
    """The last page that the links reach now from page ``at``; only links are followed, no rows read."""
    at = at or FIRST_PAGE
    while (following := peek(chain.query, chain.since, chain.until, at or None)) is not None:
        at = following
    return at


def read_stretch(fetch: Fetch, peek: Peek, part: Stretch, page_size: int) -> Iterator:
    chain, cursor = part.chain, None
    if part.start is not None:
        cursor = peek(chain.query, chain.since, chain.until, part.start or None)
    while True:
        rows, following = fetch(chain.query, chain.since, chain.until, cursor, page_size)
        yield from rows.to_batches() if isinstance(rows, pa.Table) else rows
        if (cursor or FIRST_PAGE) == part.end:
            return
        if following is None:
            raise ValueError(f"chain {chain.query!r} ends before page {part.end!r}, which it had linked")
        cursor = following


def read_limited(spark: SparkSession, name: str, order: str, limit: int) -> DataFrame:
    """The first ``limit`` rows of all chains together, by ``order``.

    Each chain has to serve its rows in that order: with ``limit_per_chain`` equal to the limit a chain
    stops paging after as many rows, and the ordered limit over the chains takes from the smaller rest.
    """
    return spark.read.format(name).load().orderBy(order).limit(limit)


def paged_source(name: str, schema: str, fetch: Fetch, chains: Sequence[Chain], page_size: int = 100,
                 limit_per_chain: int | None = None, peek: Peek | None = None) -> type[DataSource]:
    """A source class for ``spark.dataSource.register``; then ``spark.read.format(name).load()``, or
    ``spark.readStream`` where ``peek`` is given. A streamed chain keeps its place in ``chains``."""

    class Reader(DataSourceReader):
        def partitions(self):
            return list(chains)

        def read(self, partition):
            return follow(fetch, partition, page_size, limit_per_chain)

    class StreamReader(DataSourceStreamReader):
        """Stateless: the end of a batch is the last page linked now, so a restarted query goes on."""

        known: dict = {}

        def initialOffset(self):
            return {str(i): None for i in range(len(chains))}

        def latestOffset(self):
            self.known = {str(i): last_page(peek, c, self.known.get(str(i))) for i, c in enumerate(chains)}
            return self.known

        def partitions(self, start, end):
            return [Stretch(c, start.get(str(i)), end[str(i)]) for i, c in enumerate(chains)
                    if end.get(str(i)) is not None and start.get(str(i)) != end[str(i)]]

        def read(self, partition):
            return read_stretch(fetch, peek, partition, page_size)

    class Paged(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return schema

        def reader(self, schema):
            return Reader()

        def streamReader(self, schema):
            if peek is None:
                raise ValueError(f"{name} can't be streamed without a function that names the next page")
            return StreamReader()

    return Paged
