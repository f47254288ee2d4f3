import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest

from motionframe.llm import gnat_codes as G
from motionframe.llm.queries import queries


@pytest.mark.parametrize("n,dim,most", [(256, 16, 200), (256, 3, 3), (200, 2, 1), (40, 8, 1 << 24), (256, 16, 0), (13, 5, 2), (1, 4, 9), (256, 0, 1)])
def test_nearest_is_exact(n, dim, most):
    """Many ties, equal entries, large numbers: the lowest index of the nearest entries, always."""
    rng = np.random.default_rng(n + dim)
    entries = rng.integers(-most, most + 1, (n, dim))
    x = np.concatenate([rng.integers(-most, most + 1, (500, dim)), entries])
    index, far, _ = G.Gnat(entries).nearest(x)
    want = ((x[:, None].astype(object) - entries[None].astype(object)) ** 2).sum(axis=2).astype(np.int64) if dim else np.zeros((len(x), n), np.int64)
    assert (index == want.argmin(axis=1)).all() and (far == want.min(axis=1)).all()


def test_ranges_eliminate():
    """On parts that lie in groups, most distances are not measured."""
    rng = np.random.default_rng(3)
    centres = rng.integers(-4000, 4000, (16, 16))
    entries = np.repeat(centres, 16, axis=0) + rng.integers(-40, 41, (256, 16))
    x = entries[rng.integers(0, 256, 2000)] + rng.integers(-20, 21, (2000, 16))
    index, _, measured = G.Gnat(entries).nearest(x)
    assert (index == G.squared(x, entries).argmin(axis=1)).all() and measured < 0.3 * 2000 * 256


def brute(rows):
    """rows: (vec_id, vector, label); as the contract has it, entry by entry."""
    kept = [(i, [math.floor(1024 * float(c)) for c in v], lab) for i, v, lab in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = len(kept[0][1]) // 4
    part = lambda v, p: v[p * width : (p + 1) * width]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:256]
    books = [[part(v, p) for _, v, _ in first] for p in range(4)]
    nearest = lambda v, book: min((sum((a - b) ** 2 for a, b in zip(v, e)), i) for i, e in enumerate(book))
    for _ in range(4):
        for p in range(4):
            own = defaultdict(list)
            for _, v, _ in kept:
                own[nearest(part(v, p), books[p])[1]].append(part(v, p))
            for i, vs in own.items():
                books[p][i] = [sum(c) // len(vs) for c in zip(*vs)]
    out, by_label = [], defaultdict(int)
    for i, v, lab in kept:
        found = [nearest(part(v, p), books[p]) for p in range(4)]
        out.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), lab))
        by_label[lab] += out[-1][2]
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted(((i, c, e, by_label[lab], digest) for i, c, e, lab in out), key=repr)


def plain(df):
    return sorted(((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in df.collect()), key=repr)


def test_whole_operator(spark):
    """Nulls, NaN, infinities, repeated rows, null ids and labels, and columns named like internal ones."""
    rng = np.random.default_rng(5)
    rows = [(i, [float(c) for c in rng.integers(-3, 4, 8) / 1024 * 2 + 0.0003], i % 3 if i % 5 else None) for i in range(290)]
    rows += [(7, rows[7][1], 1)] * 40 + [(None, [0.5] * 8, 2), (None, [0.25] * 8, None)]
    bad = [(300, None, 1), (301, [None] + [0.0] * 7, 1), (302, [math.nan] * 8, 1), (303, [math.inf] + [0.0] * 7, 1)]
    d = spark.createDataFrame([(*r, 1, "x") for r in rows + bad], "vec_id long, embedding array<float>, label int, error int, code string").repartition(3)
    assert plain(G.compressed(d)) == brute(rows)


def test_small_tables(spark):
    kind = "vec_id long, embedding array<float>, label int"
    assert G.compressed(spark.createDataFrame([], kind)).count() == 0
    one = spark.createDataFrame([(1, [0.1, 0.2, 0.3, 0.4], None)], kind)
    assert [(r.code, r.error, r.label_error) for r in G.compressed(one).collect()] == [("00000000", 0, 0)]
    ragged = spark.createDataFrame([(1, [0.1] * 6, 1), (2, [0.5] * 6, 1), (3, [0.5] * 4, 1)], kind)  # the shorter one goes, 6 fill up to 8
    assert sorted((r.vec_id, r.code, r.error) for r in G.compressed(ragged).collect()) == [(1, "00000000", 0), (2, "01010100", 0)]


def test_query(spark):
    d = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{d}/embeddings.parquet").limit(300).collect()]
    got = plain(G.compressed(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")))
    assert got == brute(rows)
    out = queries()["op11_gnat_codes"](spark, d)
    assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and out.count() == 500
