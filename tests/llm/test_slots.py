import zlib
from collections import Counter, defaultdict

import pytest

from motionframe.llm import slots as S
from motionframe.llm.queries import queries


def laws(rows, n_shards):
    at = defaultdict(list)
    for r in rows:
        at[r.shard].append(r.slot)
    assert all(0 <= k < n_shards and sorted(v) == list(range(len(v))) for k, v in at.items())


def test_map_edits():
    load = {(s, 0): (s * 7919) % 1000 + 1 for s in range(512)}
    one = S.first_map(10, 512)
    two = S.edited_map(one, load, 10)
    total = [sum(load[s] for s, k in two.items() if k == i) for i in range(10)]
    assert max(total) - min(total) <= 60
    assert sum(one[s] != two[s] for s in one) < 120
    three = S.edited_map(two, load, 9)
    assert set(three.values()) == set(range(9)) and all(three[s] != 9 for s in three)
    assert sum(two[s] != three[s] for s in two) < 200
    assert S.edited_map(one, {}, 10) == one


def test_edges(spark, tmp_path):
    """Null and repeated keys, and a third of all rows the very same row."""
    docs = [(None, None), (None, None), (1, ""), (1, ""), (1, "abc"), (2, "é" * 1000)] + [(i, "t" * i) for i in range(200)] + [(77, "same")] * 700 + [(78, f"other {i}") for i in range(700)]
    d = spark.createDataFrame([(a, b, 1, 2) for a, b in docs], "doc_id long, text string, size int, slot int").repartition(5)
    m = S.measured(d)
    S.start(spark, f"{tmp_path}/map", 7)
    S.rebalance(m, f"{tmp_path}/map", 7)
    rows = S.place(m, f"{tmp_path}/map").collect()
    assert Counter((r.doc_id, r.size) for r in rows) == Counter((a, len((b or "").encode()) + 16) for a, b in docs)
    laws(rows, 7)
    total = Counter()
    for r in rows:
        total[r.shard] += r.size
    assert len(total) == 7 and max(total.values()) < 1.1 * min(total.values())
    assert len({r.shard for r in rows if r.doc_id == 77}) > 1
    slot = {}
    assert all(slot.setdefault(r.doc_id, r.vslot) == r.vslot for r in rows)  # by the key alone
    two, rows_each = S.read_map(spark, f"{tmp_path}/map", 2)
    assert all(two[r.vslot, r.piece] == r.shard for r in rows) and set(rows_each) == {r.vslot for r in rows if r.piece}
    one, _ = S.read_map(spark, f"{tmp_path}/map", 1)
    assert len(one) == S.N_SLOTS == len({s for s, _ in two})
    laws(S.place(m, f"{tmp_path}/map", 1).collect(), 7)
    none = S.measured(d.limit(0))
    assert S.place(none, f"{tmp_path}/map").count() == 0
    S.rebalance(none, f"{tmp_path}/map", 7)
    assert S.versions(spark, f"{tmp_path}/map") == [1, 2, 3]


def spread(rows):
    total = Counter()
    for r in rows:
        total[r.shard] += r.size
    return max(total.values()) / min(total.values())


def test_a_map_is_taken_up(spark, tmp_path):
    """Runs with ever more rows, a hot key and more shards, in one folder: gapless places, and only edited slots move."""
    folder = f"{tmp_path}/map"
    table = lambda n, hot: spark.createDataFrame([(i, "x" * (i * 37 % 900)) for i in range(n)] + [(10**6, f"{i:0200}") for i in range(hot)], "doc_id long, text string").repartition(4)
    S.start(spark, folder, 10, 1024)
    S.start(spark, folder, 99, 1024)  # there is one already
    before, n_before = {}, 10
    for run, (n, hot, n_shards) in enumerate([(4000, 0, 10), (5000, 3000, 10), (6000, 3500, 10), (6000, 3500, 11)]):
        m = S.measured(table(n, hot), n_slots=1024)
        by_old = S.place(m, folder).collect()
        laws(by_old, n_before)
        moved = S.rebalance(m, folder, n_shards)
        rows = S.place(m, folder).collect()
        laws(rows, n_shards)
        assert spread(rows) < 1.02 and len(rows) == n + hot
        old = {(r.doc_id, r.text_crc32): (r.vslot, r.shard) for r in by_old}
        edited = {s for s, _ in moved}
        assert all(r.vslot in edited for r in rows if old[r.doc_id, r.text_crc32] != (r.vslot, r.shard))
        assert all(before.get(r.doc_id, r.vslot) == r.vslot for r in rows)
        before = {r.doc_id: r.vslot for r in rows}
        n_before = n_shards
        assert S.versions(spark, folder) == list(range(1, run + 3))
        assert run == 0 or len(edited) < 400
    same = S.place(m, folder, 2)
    laws(same.collect(), 10)
    with pytest.raises(Exception, match="(?i)exists"):
        S.write_map(spark, folder, 2, {})


def test_slots_do_not_depend_on_texts(spark, tmp_path):
    d = spark.createDataFrame([(i, "t" * i) for i in range(300)], "doc_id long, text string")
    a = {r.doc_id: r.vslot for r in S.slotted(d).selectExpr("key doc_id", "vslot").collect()}
    b = {r.doc_id: r.vslot for r in S.slotted(d.selectExpr("doc_id", "'changed' text")).selectExpr("key doc_id", "vslot").collect()}
    assert a == b and len(set(a.values())) > 250


def test_query(spark):
    d = "/root/testdata/sf0.1"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    rows = queries()["op8_virtual_slots"](spark, d).collect()
    assert len(rows) == len(texts)
    total = defaultdict(int)
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "bytes", None)
        total[r.shard] += r.size
    laws(rows, 40)
    assert len(total) == 40 and max(total.values()) < 1.01 * min(total.values())
    moved = {r.vslot for r in rows if r.shard != r.first_shard}
    stayed = {r.vslot for r in rows if r.shard == r.first_shard}
    assert 0 < len(moved) < len(stayed)
