"""Activity and tags over a stream of articles, of which later versions replace earlier ones.

State is one row for each article: what its last version counted for. A newer version gives the difference; summed up, the
differences are what the batch operators count over the last versions. They go to a sink that can only append, and state
and sink are restored from the checkpoint, so that a stopped stream goes on where it was.

That calls Python for each article (more than 115 s for 150,000 on 8 cores), so it is for streams of few changes that are
read often. Where a great many articles come at once, the stream appends its versions to the sink as they are, without
state, and logged_activity finds the last ones when it is asked, in one shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.opinions import activity

#: What counts of an article: its group, day, opinions, votes and tags.
COUNTED = ("by", "day", "n_opinions", "n_votes", "tags")
STATE = "version timestamp, line string, by string, day timestamp, n_opinions long, n_votes long, tags array<string>"
CHANGES = "kind string, by string, day timestamp, tag string, n_articles long, n_opinions long, n_votes long"


def article_counts(articles: DataFrame, by: str = "type", version: str = "date_scraped") -> DataFrame:
    """_id, version, line (settles versions of one time), and what counts of each article as read_articles has them."""
    votes = F.aggregate("comments", F.lit(0).cast("long"), lambda a, c: a + F.coalesce(c["votes_up"], F.lit(0)) + F.coalesce(c["votes_down"], F.lit(0)))
    return articles.select(
        "_id", F.col(version).alias("version"), F.to_json(F.struct(*[F.col(f"`{c}`") for c in articles.columns])).alias("line"), F.col(by).cast("string").alias("by"), F.date_trunc("DAY", "date_published").alias("day"),
        F.coalesce(F.size("comments"), F.lit(0)).cast("long").alias("n_opinions"), F.coalesce(votes, F.lit(0)).alias("n_votes"), F.coalesce("tags", F.array().cast("array<string>")).alias("tags"),
    )


def _changes(was: tuple | None, now: tuple) -> list[tuple]:
    out = []
    for sign, one in ((-1, was), (1, now)):
        if one is not None:
            by, day, opinions, votes, tags = one
            if day is not None and not pd.isna(day):
                out.append(("day", by, day, None, sign, sign * opinions, sign * votes))
            out += [("tag", None, None, t, sign, 0, 0) for t in tags]
    return out


def _replace(key: tuple, rows: Iterator[pd.DataFrame], state: GroupState, keep_ms: int) -> Iterator[pd.DataFrame]:
    if state.hasTimedOut:
        state.remove()
        return
    was = state.get if state.exists else None
    best = tuple(was[:2]) if was else None
    last = None
    for batch in rows:
        for r in batch.itertuples(index=False):
            mark = (r.version, r.line)
            if best is None or mark > best:
                best, last = mark, (r.by, r.day, int(r.n_opinions), int(r.n_votes), list(r.tags))
    if last is None:
        return
    before = tuple(was[2:]) if was else None
    state.update((best[0], best[1], last[0], None if pd.isna(last[1]) else last[1], last[2], last[3], last[4]))
    state.setTimeoutTimestamp(max(int(best[0].timestamp() * 1000), state.getCurrentWatermarkMs()) + keep_ms)
    changes = _changes(before, last)
    if changes:
        yield pd.DataFrame(changes, columns=[c.split()[0] for c in CHANGES.split(", ")]).astype({"day": "datetime64[ns]"})


def article_changes(counts: DataFrame, late: str = "2 days", keep_days: int = 30) -> DataFrame:
    """Changes of the counts that a stream of article_counts brings, to be appended to a sink. Versions older than the watermark
    (late) are left out, and so are articles and versions without a time. An article's state is kept so many days
    behind its last version; a version that comes later yet counts as a new article."""
    timed = counts.filter(F.col("version").isNotNull() & F.col("_id").isNotNull()).withWatermark("version", late)
    keep_ms = keep_days * 86_400_000

    def run(key: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        yield from _replace(key, rows, state, keep_ms)

    return timed.groupBy("_id").applyInPandasWithState(run, CHANGES, STATE, "append", GroupStateTimeout.EventTimeTimeout)


def activity_of(changes: DataFrame) -> DataFrame:
    """by, day, opinion_count, interaction_count from all changes so far."""
    sums = changes.filter("kind = 'day'").groupBy("by", "day").agg(F.sum("n_articles").alias("_n"), F.sum("n_opinions").alias("opinion_count"), F.sum("n_votes").alias("interaction_count"))
    return sums.filter("_n > 0").drop("_n")


def tags_of(changes: DataFrame) -> DataFrame:
    """tag, score (articles' uses of it) from all changes so far."""
    return changes.filter("kind = 'tag'").groupBy("tag").agg(F.sum("n_articles").alias("score")).filter("score > 0")


def last_versions(counts: DataFrame) -> DataFrame:
    """The batch form: of article_counts each article's last version."""
    whole = F.struct(*[F.col(c) for c in counts.columns])
    return counts.filter(F.col("version").isNotNull() & F.col("_id").isNotNull()).groupBy("_id").agg(F.max_by(whole, F.struct("version", "line")).alias("_w")).select("_w.*")


def logged_activity(log: DataFrame) -> DataFrame:
    """by, day, opinion_count, interaction_count of the last versions in a sink to which a stream of article_counts appends."""
    dated = last_versions(log.select("_id", "version", "line", "by", "day", "n_opinions", "n_votes"))
    return activity(dated, "by", "day")
