"""WARC fixity audit with Merkle trees, in DataFrame operations alone.

Pages are rendered as WARC records, put in order by id and digest, and cut into archives of `ARCHIVE_RECORDS` each; in an
archive each record has the offset range that its bytes take. The leaves of a replica's tree are the digests of its
records; a node covers `FANOUT` neighbours below it, in order, with the offset range from the first to the last, and its
digest is that of their digests and ranges. Above the archives' roots the levels go on over the archives in order, up to
one root. Trees of replicas that are compared have one `shape`, which holds the largest archive of either, however large.

The audit compares the roots, and then, level by level, only the children of nodes that differ, down to the records:
those changed, those missing and those that only the copy has. Levels are written once; every group has FANOUT members
at most, every join is on a node's key, and where the roots agree nothing below is read.

Order: each row has a number, written with it, by which its bytes and its place find each other and which comes last in
the order, so that ids, and even whole rows, may repeat as often as they like: no key is dealt to one task.

Nulls: a null url or html is empty, a null id is written as "null" and comes first. Repeated rows are records of their
own. Empty tables have an empty root and agree. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motionframe.session import written

FANOUT = 16
ARCHIVE_RECORDS = 1000
_CRLF = "\r\n"


def record_bytes(page_id: Column, url: Column, html: Column) -> Column:
    """A WARC/1.1 resource record."""
    body = F.coalesce(html, F.lit(""))
    digest = F.sha2(body, 256)
    header = F.concat(
        F.lit(f"WARC/1.1{_CRLF}WARC-Type: resource{_CRLF}WARC-Record-ID: <urn:sha256:"),
        F.sha2(F.concat_ws("|", F.coalesce(page_id.cast("string"), F.lit("null")), F.coalesce(url, F.lit("")), digest), 256),
        F.lit(f">{_CRLF}WARC-Target-URI: "),
        F.coalesce(url, F.lit("")),
        F.lit(f"{_CRLF}WARC-Payload-Digest: sha256:"),
        digest,
        F.lit(f"{_CRLF}Content-Type: text/html{_CRLF}Content-Length: "),
        F.octet_length(body).cast("string"),
        F.lit(_CRLF * 2),
    )
    return F.encode(F.concat(header, body, F.lit(_CRLF * 2)), "UTF-8")


def archived(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """row, record_id and bytes of each page. The pages are written once, so that the row numbers hold."""
    rows = pages.select(F.col(id_col).alias("record_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "pages")
    return rows.select("row", "record_id", record_bytes(F.col("record_id"), F.col("url"), F.col("html")).alias("bytes"))


def leaves(records: DataFrame, size: int = ARCHIVE_RECORDS) -> DataFrame:
    """row, archive, ordinal, record_id, start, end and digest; offsets are those in the archive. The bytes are not shuffled.

    Places are found in two levels: rows of each range of the order, and the place within the range.
    """
    short = written(records.select("row", "record_id", F.octet_length("bytes").cast("long").alias("length"), F.sha2("bytes", 256).alias("digest")), "records")
    order = ["record_id", "digest", "row"]
    dealt = written(short.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()), "order")
    part = F.shiftright("place", 33)
    counts = dealt.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("n"))  # one row a partition
    before = F.coalesce(F.sum("n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = dealt.join(F.broadcast(counts.select("__part", before.alias("before"))), part == F.col("__part"))
    nth = F.col("before") + F.col("place").bitwiseAND((1 << 33) - 1)
    placed = placed.select("row", F.floor(nth / size).alias("archive"), (nth % size).alias("ordinal"), "record_id", "length", "digest")
    end = F.sum("length").over(Window.partitionBy("archive").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return placed.select("row", "archive", "ordinal", "record_id", (end - F.col("length")).alias("start"), end.alias("end"), "digest")


def copied(leaves_: DataFrame, copy: DataFrame) -> DataFrame:
    """Leaves of a copy: the digests that its bytes have at the offset ranges that leaves_ gives. copy: (archive, start, bytes).

    A copy may have the digests of its bytes in place of them, (archive, start, digest), so that no bytes are shuffled.
    """
    found = copy.select("archive", "start", (F.col("digest") if "digest" in copy.columns else F.sha2("bytes", 256)).alias("__digest"))
    at = leaves_.select("archive", "ordinal", "record_id", "start", "end")
    return at.join(found, ["archive", "start"]).withColumn("digest", F.col("__digest")).drop("__digest")


def shape(*replicas: DataFrame, fanout: int = FANOUT) -> tuple[int, int]:
    """(archives, levels of an archive): the largest of all replicas' leaves."""
    found = [r.agg(F.max("archive"), F.max("ordinal")).first() for r in replicas]
    archives, records = (1 + max([f[i] for f in found if f[i] is not None], default=0) for i in (0, 1))
    levels = 1
    while fanout**levels < records:
        levels += 1
    return archives, levels


def tree(leaves_: DataFrame, n_archives: int, levels: int, fanout: int = FANOUT) -> list[DataFrame]:
    """The levels of a replica's tree, from the root down to the leaves: (node, parent, start, end, digest, ...).

    Node numbers are archive * fanout ** levels + ordinal at the leaves, and a parent is its child's number // fanout.
    """
    width = fanout**levels
    level = written(leaves_.select((F.col("archive") * width + F.col("ordinal")).alias("node"), "start", "end", "digest", "archive", "ordinal", "record_id").withColumn("parent", F.floor(F.col("node") / fanout)), "leaves")
    out, top = [level], n_archives * width
    while top > 1:
        child = F.array_sort(F.collect_list(F.struct("node", "start", "end", "digest")))
        said = F.array_join(F.transform(child, lambda c: F.concat_ws(":", c["node"], c["start"], c["end"], c["digest"])), ",")
        level = level.groupBy(F.col("parent").alias("node")).agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sha2(said, 256).alias("digest"))
        level = written(level.withColumn("parent", F.floor(F.col("node") / fanout)), "level")
        out.append(level)
        top = -(-top // fanout)
    return out[::-1]


def audit(original: list[DataFrame], copy: list[DataFrame]) -> DataFrame:
    """The records that differ: archive, ordinal, record_id, start, end and status (changed, missing or extra)."""
    open_ = None
    for mine, other in zip(original, copy):
        a, b = (x.withColumn("digest", F.coalesce("digest", F.lit(""))) for x in (mine, other))
        if open_ is not None:
            a, b = (x.join(open_, x["parent"] == open_["open"], "left_semi") for x in (a, b))
        b = b.select(F.col("node").alias("__node"), *(F.col(c).alias(f"__{c}") for c in b.columns if c != "node"))
        both = a.join(b, a["node"] == b["__node"], "full_outer").where(~F.col("digest").eqNullSafe(F.col("__digest")))
        open_ = both.select(F.coalesce("node", "__node").alias("open")).distinct()
        if mine is not original[-1]:
            open_ = written(open_, "open")
    status = F.when(F.col("__node").isNull(), "missing").when(F.col("node").isNull(), "extra").otherwise("changed")
    return both.select(*(F.coalesce(c, f"__{c}").alias(c) for c in ("archive", "ordinal", "record_id", "start", "end")), status.alias("status"))
