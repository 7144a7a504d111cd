"""Site-relative line deduplication: lines on too large a share of a host's pages go."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickflow.llm.common import small_side

# A line goes if it stands on more than this share of its host's pages ...
MAX_RATIO = 0.1
# ... and on at least so many of them: a host of few pages has no boilerplate to speak of.
MIN_PAGES = 10


def _lines(text):
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _digest(line):
    return F.unhex(F.md5(line))


def boilerplate(df: DataFrame, host: str = "source", text: str = "text", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES, copies_once: bool = False) -> DataFrame:
    """The boilerplate lines of each host: host, drop (their md5 digests).

    A page counts once for each of its different lines; blank lines are never boilerplate.
    Counting by (host, digest) merges before the shuffle, so neither a hot host nor a hot
    line gathers its rows. A host's lines above the ratio number at most its mean lines per
    page divided by the ratio, which bounds the list. Null hosts form one host; null text
    is a page of one blank line. With ``copies_once`` all pages of a host with the same text
    are one page, so copies do not make their own lines boilerplate; they are merged before
    the shuffle, so a large group of copies gathers nowhere.
    """
    pages = df.select(F.col(host).alias("host"), F.col(text).alias("text"))
    # Words of ASCII white space only make a line blank.
    spoken = F.filter(_lines(F.col("text")), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    lines = F.transform(F.array_distinct(spoken), _digest).alias("digests")
    if copies_once:
        page = _digest(F.coalesce(F.col("text"), F.lit(""))).alias("page")
        pages = pages.select("host", page, lines).groupBy("host", "page").agg(F.first("digests").alias("digests"))
    else:
        pages = pages.select("host", lines)
    totals = pages.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    lines = pages.select("host", F.explode("digests").alias("digest"))
    counted = lines.groupBy("host", "digest").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_pages)
    found = counted.withColumnRenamed("host", "line_host").join(totals, F.col("line_host").eqNullSafe(F.col("host")))
    found = found.filter(F.col("n") > F.lit(max_ratio) * F.col("pages"))
    return found.groupBy("host").agg(F.collect_list("digest").alias("drop"))


def line_dedup(
    df: DataFrame, host: str = "source", text: str = "text", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES, copies_once: bool = False
) -> DataFrame:
    """``df`` with boilerplate lines taken out of ``text`` and ``__removed``, their number.

    All rows and all other columns stay, repeated rows too. A text that loses every line is
    empty; null text stays null with nothing removed. The other lines keep their order and
    their line ends. ``copies_once``: see ``boilerplate``. Large lists of boilerplate are joined by shuffle on the host, where Spark splits
    a hot host, small ones by broadcast.
    """
    drop = small_side(boilerplate(df, host, text, max_ratio, min_pages, copies_once), "boilerplate")
    drop = drop.select(F.col("host").alias("__host"), F.col("drop").alias("__drop"))
    joined = df.join(drop, F.col(host).eqNullSafe(F.col("__host")), "left")
    lines = _lines(F.col(text))
    kept = F.filter(lines, lambda line: ~F.array_contains(F.col("__drop"), _digest(line)))
    clean = F.when(F.col("__drop").isNull() | F.col(text).isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))
    removed = F.when(F.col("__drop").isNull() | F.col(text).isNull(), 0).otherwise(F.size(lines) - F.size(kept))
    columns = [F.col(f"`{c}`") if c != text else clean.alias(text) for c in df.columns]
    return joined.select(*columns, removed.cast("long").alias("__removed"))
