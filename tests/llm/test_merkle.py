import hashlib
import zlib
from collections import Counter

from pyspark.sql import functions as F

from motionframe.llm import merkle as M
from motionframe.llm.queries import queries

PAGES = [(i, f"http://x/{i}", "p" * (i % 7) + str(i)) for i in range(400)] + [(None, None, None), (5, "http://x/5", "ppppp5"), (5, "http://x/5", "ppppp5"), (900, "u", "é" * 200_000)]


def sha(b):
    return hashlib.sha256(b).hexdigest()


def record(page_id, url, html):
    """A record, written apart from the operator."""
    body, url = (html or "").encode(), url or ""
    name = sha(f"{'null' if page_id is None else page_id}|{url}|{sha(body)}".encode())
    head = ["WARC/1.1", "WARC-Type: resource", f"WARC-Record-ID: <urn:sha256:{name}>", f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha256:{sha(body)}", "Content-Type: text/html", f"Content-Length: {len(body)}", "", ""]
    return "\r\n".join(head).encode() + body + b"\r\n\r\n"


def archives(pages, size):
    """Lists of (id, bytes, start, end)."""
    rows = sorted(((p[0], record(*p)) for p in pages), key=lambda r: (r[0] is not None, r[0] or 0, sha(r[1])))
    out = []
    for i in range(0, len(rows), size):
        at, one = 0, []
        for r, b in rows[i : i + size]:
            one.append((r, b, at, at + len(b)))
            at += len(b)
        out.append(one)
    return out


def root(leaves, width):
    """The digest of the whole tree over (archive, ordinal, start, end, digest)."""
    level = {a * width + o: (s, e, d) for a, o, s, e, d in leaves}
    top = (max(a for a, *_ in leaves) + 1) * width
    while top > 1:
        groups = {}
        for node in sorted(level):
            groups.setdefault(node // 16, []).append(node)
        level = {g: (min(level[n][0] for n in c), max(level[n][1] for n in c), sha(",".join(f"{n}:{level[n][0]}:{level[n][1]}:{level[n][2]}" for n in c).encode())) for g, c in groups.items()}
        top = -(-top // 16)
    return level[0][2]


def test_tree_is_that_of_hashlib(spark):
    pages = spark.createDataFrame([(*p, 1) for p in PAGES], "page_id long, url string, html string, archive int").repartition(5)
    want = [(a, o, s, e, sha(b)) for a, one in enumerate(archives(PAGES, 50)) for o, (_, b, s, e) in enumerate(one)]
    mine = M.leaves(M.archived(pages), 50)
    assert sorted(tuple(r) for r in mine.select("archive", "ordinal", "start", "end", "digest").collect()) == want
    shape = M.shape(mine)
    assert shape == (9, 2)
    (top,) = M.tree(mine, *shape)[0].collect()
    assert top.digest == root(want, 16**2)
    one = M.leaves(M.archived(pages), 10_000)  # one archive for all
    assert M.shape(one) == (1, 3)


def test_audit_finds_each_difference(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    mine = M.leaves(M.archived(pages), 50).cache()
    shape = M.shape(mine)
    rows = mine.orderBy("archive", "ordinal").collect()
    top = M.tree(mine, *shape)
    assert M.audit(top, M.tree(mine, *shape)).count() == 0
    gone = {(2, 47), (2, 48), (2, 49)}
    bad = {(r.archive, r.ordinal) for r in rows if (r.record_id or 0) % 31 == 4} - gone
    key = F.struct("archive", "ordinal")
    mark = lambda s: key.isin([F.struct(F.lit(a).cast("long"), F.lit(o).cast("long")) for a, o in s])
    other = mine.where(~mark(gone)).withColumn("digest", F.when(mark(bad), F.lit("x")).otherwise(F.col("digest")))
    found = M.audit(top, M.tree(other, *shape)).collect()
    assert {(r.archive, r.ordinal, r.status) for r in found} == {(*k, "missing") for k in gone} | {(*k, "changed") for k in bad}
    back = M.audit(M.tree(other, *shape), top).collect()
    assert {(r.archive, r.ordinal) for r in back if r.status == "extra"} == gone


def test_record_and_empty(spark):
    (r,) = spark.createDataFrame([(1, "http://a", "é")], "a long, u string, h string").select(M.record_bytes(F.col("a"), F.col("u"), F.col("h")).alias("b")).collect()
    assert bytes(r.b) == record(1, "http://a", "é")
    none = spark.createDataFrame([], "page_id long, url string, html string")
    mine = M.leaves(M.archived(none))
    shape = M.shape(mine, mine)
    assert M.audit(M.tree(mine, *shape), M.tree(mine, *shape)).count() == 0


def audited(pages):
    """What the query finds, by brute force."""
    want = Counter()
    for a, one in enumerate(archives(pages, M.ARCHIVE_RECORDS)):
        for o, (r, _, s, e) in enumerate(one):
            if a % 29 == 3 and o + 5 > len(one) - 1:
                want[a, o, r, s, e, "missing"] += 1
            elif r is not None and zlib.crc32(str(r).encode()) % 97 == 0:
                want[a, o, r, s, e, "changed"] += 1
    return want


def ran(spark, d):
    return Counter((r.archive, r.ordinal, r.record_id, r.start, r.end, r.status) for r in queries()["op4_merkle_audit"](spark, d).collect())


def test_query(spark):
    d = "/root/testdata/sf0.1"
    want = audited([tuple(r) for r in spark.read.parquet(f"{d}/pages.parquet").select("page_id", "url", "html").collect()])
    assert ran(spark, d) == want and len(want) > 10


HIT = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 97 == 0]


def test_query_with_null_and_repeated_rows(spark, tmp_path):
    rows = [(i, f"http://x/{i}", "p" * (i % 7)) for i in range(400)] + [(None, f"http://n/{i}", "n") for i in range(30)] + [(None, None, None)] * 2
    rows += [(HIT[0], f"http://r/{i}", "r" * i) for i in range(40)] + [(HIT[1], "http://same", "same")] * 5 + [(7, "http://hot", "hot")] * 5000
    spark.createDataFrame(rows, "page_id long, url string, html string").repartition(7).write.parquet(f"{tmp_path}/pages.parquet")
    want = audited(rows)
    assert ran(spark, str(tmp_path)) == want and sum(x[2] == HIT[0] and x[5] == "changed" for x in want) >= 40 and any(x[5] == "missing" for x in want)


def test_copies_by_their_digests(spark):
    """A copy's digests stand for its bytes, so that these need not be shuffled."""
    leaves = spark.createDataFrame([(0, 0, 7, 0, 3), (0, 1, 8, 3, 5)], "archive long, ordinal long, record_id long, start long, end long")
    copy = spark.createDataFrame([(0, 0, bytearray(b"abc")), (0, 3, bytearray(b"de"))], "archive long, start long, bytes binary")
    said = copy.selectExpr("archive", "start", "sha2(bytes, 256) AS digest")
    assert sorted(map(tuple, M.copied(leaves, said).collect())) == sorted(map(tuple, M.copied(leaves, copy).collect()))
