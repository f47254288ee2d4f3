"""Token ids in files, compressed by Re-Pair: grammar rules for frequent pairs, shard by shard.

Documents are dealt by ranges of id and sorted, so that files hold them in ascending order. A shard are consecutive
documents of about `SHARD_IDS` ids (one longer document is a shard of its own). In each round the frequent pairs of
adjacent symbols get a new symbol each, the nonterminal; where pairs overlap, the more frequent one is replaced and the
other waits for a later round. The grammar is complete when no pair is frequent: pairs are counted exactly, and neither
rounds nor rules are bounded. `rarest` says which pairs are frequent, down to those that occur twice. No rule reaches over
the end of a document, so each document is a run of whole symbols.

The file format is a Parquet table with one row for each shard, in order of (part, shard):

    doc_ids     array<bigint>   its documents, ascending
    n_symbols   array<int>      symbols of each
    n_tokens    array<int>      ids of each
    first_rule  int             the first nonterminal; smaller symbols are ids
    rules       binary          pairs of symbols, little-endian unsigned 32-bit; rule k expands first_rule + k
    lengths     binary          ids that each rule expands to, unsigned 32-bit
    symbols     binary          the shard, little-endian unsigned, 16-bit where all symbols fit and else 32-bit
    width       int             bytes of a symbol

`n_symbols` gives a document's place in `symbols`, and `lengths` the place of an id in a run of symbols, so that any
document, or any range of ids in it, is decoded by itself (`document_ids`). Spark's writer commits the files, so a task
that is run again leaves nothing twice.

Ids are those of the tokenizers library for the whole text. Texts in Latin-1 without special tokens are cut into the
pattern's pieces, and the library encodes the distinct ones that are new in one call a batch, since neither normalisation
nor merging crosses pieces there; all other texts are encoded whole.

Nulls: a null text is empty, a null id comes first. Rows that share an id stand next to each other, by text. An empty
table gives an empty file table. Extra columns are not read.
"""

from __future__ import annotations

import os
import unicodedata
import uuid
import zlib
from collections.abc import Iterator
from itertools import compress as picked
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from motionframe.llm.common import by_bytes, ddl
from motionframe.llm.prefix_bpe import byte_chars

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

END = 2
SHARD_IDS = 1 << 20
#: A pair is frequent if it is one in so many of a shard's pairs: 8 in a full one, where a rule takes 12 bytes and saves 2 a use.
RAREST = 1 << 17
#: Pieces that a worker remembers.
CACHE = 800_000
#: Texts are encoded in batches of about so many bytes.
TEXT_BYTES = 4 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)
# The vocabulary's pattern 's|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+ within Latin-1.
_ONE, _TWO = list(b"stmd"), [tuple(b"re"), tuple(b"ve"), tuple(b"ll")]
#: For each Latin-1 character: 0 white space, 1 letter, 2 digit, 3 other; and its lower case.
_KIND = np.array([0 if c in "\t\n\v\f\r \x85\xa0" else {"L": 1, "N": 2}.get(unicodedata.category(c)[0], 3) for c in map(chr, range(256))], np.uint8)
_LOWER = np.array([ord(c.lower()) for c in map(chr, range(256))], np.uint8)
FILE_FIELDS = [
    ("part", pa.int32()),
    ("shard", pa.int32()),
    ("doc_ids", pa.list_(pa.int64())),
    ("n_symbols", pa.list_(pa.int32())),
    ("n_tokens", pa.list_(pa.int32())),
    ("n_ids", pa.int64()),
    ("first_rule", pa.int32()),
    ("rules", pa.binary()),
    ("lengths", pa.binary()),
    ("symbols", pa.binary()),
    ("width", pa.int32()),
]


def gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs of flat that start at starts and have these sizes, one after another."""
    ends = np.cumsum(sizes)
    return flat[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)]


def cut_pieces(latin: np.ndarray, row_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(where pieces start, where white space is) in lower-cased Latin-1; no piece reaches over the start of a row.

    A piece is a run of letters, a digit, or a run of other characters; an apostrophe that starts such a run is a piece
    with the contracted letters after it.
    """
    kind = _KIND[latin]
    start = np.ones(len(latin), bool)
    start[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
    start[row_starts] = True
    at = np.flatnonzero((latin == 39) & start)
    if len(at):
        longer = np.r_[latin, 0, 0]
        starts = np.zeros(len(latin) + 2, bool)
        starts[row_starts] = True
        one, two = np.where(starts[at + 1], 0, longer[at + 1]), np.where(starts[at + 1] | starts[at + 2], 0, longer[at + 2])
        size = np.where(np.isin(one, _ONE), 2, 0)
        for x, y in _TWO:
            size[(one == x) & (two == y)] = 3
        at, size = at[size > 0], size[size > 0]
        start[at + 1] = False
        nth = at + size
        start[nth[nth < len(latin)]] = True
    return start, kind == 0


class Encoder:
    """Texts to ids with the tokenizers library, a batch of texts at once.

    Texts are cut into the pieces of the vocabulary's pattern; the library encodes the distinct pieces that are new, in
    one call a batch.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        chars = byte_chars()
        self.chars = np.zeros(256, "<u2")  # a piece's bytes as the model has them
        self.chars[list(chars.values())] = list(map(ord, chars))
        self.chars[32] = 32  # between pieces
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        self.n_bytes = np.zeros(max(vocab.values()) + 1, np.int64)
        self.n_bytes[list(vocab.values())] = [len(t.removesuffix("</w>")) for t in vocab]
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self._forget()

    def _forget(self) -> None:
        """The ids of pieces seen lately, one after another: piece k has sizes[k] ids from starts[k] on."""
        self.at: dict[bytes, int] = {}
        self.flat, self.sizes, self.starts = np.zeros(0, "<u4"), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, and how many each has."""
        raw = np.frombuffer(b" ".join(pieces).decode("latin-1").encode(), np.uint8)
        said = self.chars[raw].tobytes().decode("utf-16-le")
        flat = np.array(self.model.encode_batch_fast([said], add_special_tokens=False)[0].ids, "<u4")
        ends = np.r_[np.flatnonzero(raw == 32), len(raw)] - np.arange(len(pieces))  # every piece ends where an id ends
        return flat, np.diff(np.r_[0, np.searchsorted(np.cumsum(self.n_bytes[flat]), ends, "right")])

    def _numbers(self, pieces: list[bytes]) -> np.ndarray:
        """The number of each of these distinct pieces."""
        found = np.fromiter(map(self.at.get, pieces, repeat(-1)), np.int64, len(pieces))
        is_new = found < 0
        if is_new.any() and len(self.at) + int(is_new.sum()) > CACHE:
            self._forget()
            is_new[:] = True
        if is_new.any():
            new = list(picked(pieces, is_new))
            flat, sizes = self._encode(new)
            found[is_new] = np.arange(len(self.at), len(self.at) + len(new))
            self.at.update(zip(new, range(len(self.at), len(self.at) + len(new))))
            self.flat, self.sizes = np.concatenate([self.flat, flat]), np.concatenate([self.sizes, sizes])
            self.starts = np.cumsum(self.sizes) - self.sizes
        return found

    def _whole(self, texts: pa.StringArray, at: np.ndarray, data: np.ndarray) -> np.ndarray:
        """Where a text has a special token or a character beyond Latin-1: there normalisation may join what is apart."""
        out = np.zeros(len(texts), bool)
        for s in self.special:
            out |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        far = np.flatnonzero(data >= 0xC4)  # the first byte of such a character
        out[np.searchsorted(at, far, "right") - 1] = True
        return out

    def __call__(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, how many each has). Nulls are empty."""
        texts = pc.fill_null(texts, "")
        at, data = _buffers(texts)
        whole = self._whole(texts, at, data)
        if whole.any():
            at, data = _buffers(pc.if_else(pa.array(whole), "", texts))
        lead = np.flatnonzero(data >= 0xC2)  # of two bytes for one character
        latin = data.copy()
        latin[lead + 1] = (data[lead] << 6) | (data[lead + 1] & 0x3F)
        latin = _LOWER[np.delete(latin, lead) if len(lead) else latin]
        row_ends = at - np.searchsorted(lead, at)
        start, space = cut_pieces(latin, row_ends[:-1][np.diff(row_ends) > 0])
        held = ~space
        ends = np.flatnonzero(start[held])
        size = int(held.sum())
        offsets = np.r_[ends, size].astype(np.int32) if size else np.zeros(1, np.int32)
        pieces = pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(latin[held])]).dictionary_encode()
        k = self._numbers(pieces.dictionary.to_numpy(zero_copy_only=False).tolist())[pieces.indices.to_numpy()]
        sizes = self.sizes[k]
        flat = gathered(self.flat, self.starts[k], sizes)
        before = np.searchsorted(np.flatnonzero(start & held), row_ends)  # pieces before each row
        n = np.diff(np.r_[0, np.cumsum(sizes)][before])
        if whole.any():
            ids = np.split(flat, np.cumsum(n)[:-1])
            for i in np.flatnonzero(whole).tolist():
                ids[i] = np.array(self.tokenizer.encode(texts[i].as_py(), add_special_tokens=False).ids, "<u4")
                n[i] = len(ids[i])
            flat = np.concatenate(ids)
        return flat, n


def _buffers(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """(where each text starts, with the end; the bytes)."""
    _, at, data = texts.buffers()
    at = np.frombuffer(at, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return at - at[0], (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8))[at[0] : at[-1]]


_loaded: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]


def frequent(pairs: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(the distinct pairs that occur at least `least` times, sorted; where in pairs they are; which one stands there)."""
    v = np.sort(pairs)
    starts = np.r_[0, np.flatnonzero(v[1:] != v[:-1]) + 1]
    found = v[starts[np.diff(np.r_[starts, len(v)]) >= least]] if len(v) else v
    nearest = lambda x: np.minimum(np.searchsorted(found, x), len(found) - 1)
    if not len(found):
        return found, np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(pairs) < 1 << 13:
        j = nearest(pairs)
        i = np.flatnonzero(found[j] == pairs)
        return found, i, j[i]
    slot = lambda x: (x.view(np.uint64) * _MIX >> np.uint64(47)).view(np.int64)
    table = np.full(1 << 17, -1)
    table[slot(found)] = np.arange(len(found))
    j = table[slot(pairs)]
    i = np.flatnonzero(j >= 0)
    j, p = j[i], pairs[i]
    other = np.flatnonzero(found[j] != p)  # infrequent, or it shares its slot
    j[other] = nearest(p[other])
    ok = np.ones(len(i), bool)
    ok[other] = found[j[other]] == p[other]
    return found, i[ok], j[ok]


def compress(ids: np.ndarray, ends: np.ndarray, first_rule: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rules (pairs), symbols and the symbols of each document, until no pair occurs `least` times without overlaps.

    ends: of the documents in ids, exclusive. A symbol that a replacement removes is skipped by the links of its
    neighbours, so that a round looks at positions of frequent pairs only. A pair becomes frequent when its later symbol
    is made, or never: only pairs with a new symbol are counted anew.
    """
    n = len(ids)
    s = np.zeros(n + 1, np.int64)
    s[:n] = ids
    last = np.zeros(n + 1, bool)
    last[ends[ends > 0] - 1] = last[n] = True
    after, before = np.arange(1, n + 2), np.arange(-1, n)
    before[0] = n
    live = np.ones(n, bool)
    rank, code = np.zeros(n + 1, np.int64), np.full(n + 1, -1)
    pairs, rules, made = np.zeros(0, np.int64), [], 0
    at, hot = np.flatnonzero(~last[:n]), np.zeros(0, np.int64)
    while True:
        new, i, j = frequent(s[at] << 32 | s[after[at]], least)
        at = at[i]
        code[at] = j + len(pairs)
        pairs = np.r_[pairs, new]
        hot = np.r_[hot, at] if len(hot) else at
        hot.sort()
        counts = np.bincount(code[hot], minlength=len(pairs))
        order = np.flatnonzero(counts >= least)
        # The rarest first; of equally frequent ones any, by a hash, so that those of a long repeat don't wait in a row.
        order = order[np.lexsort((pairs[order].view(np.uint64) * _MIX, counts[order]))]
        ranks = np.zeros(len(pairs), np.int64)
        ranks[order] = np.arange(1, len(order) + 1)
        r = ranks[code[hot]]
        code[hot[r == 0]] = -1
        hot, r = hot[r > 0], r[r > 0]
        rank[hot] = r
        run = hot[rank[after[hot]] == r]
        if len(run):  # of a run of one symbol every second pair counts, from the left
            run = np.union1d(run, after[run])
            run = run[np.argsort(rank[run], kind="stable")]
            nth = np.arange(len(run))
            first = np.maximum.accumulate(np.where(rank[before[run]] != rank[run], nth, 0))
            rank[run[(nth - first) % 2 == 1]] = 0
            r = rank[hot]
        win = np.flatnonzero((r > rank[after[hot]]) & (r > rank[before[hot]]))  # the more frequent of overlapping pairs
        rank[hot] = 0
        pos, r = hot[win], r[win] - 1
        good = np.bincount(r, minlength=len(order)) >= least
        if not good.any():
            # The most frequent pair overlaps itself alone: it is not frequent, and the others have their turn.
            if not len(order):
                break
            code[hot[code[hot] == order[-1]]] = -1
            at = at[:0]
        else:
            pos, r = pos[good[r]], r[good[r]]
            rules.append(pairs[order[good]])
            s[pos] = (first_rule + made - 1 + np.cumsum(good))[r]
            made += int(good.sum())
            gone = after[pos]
            live[gone] = False
            ended = last[gone]
            last[pos] = ended
            after[pos] = after[gone]
            before[after[pos]] = pos
            left = before[pos]
            left = left[~last[left]]
            code[pos] = code[gone] = code[left] = -1
            rank[pos] = 1
            at = np.sort(np.concatenate([pos[~ended], left[rank[left] == 0]]))
            rank[pos] = 0
        hot = hot[code[hot] >= 0]
        kept = np.zeros(len(pairs), bool)
        kept[code[hot]] = True
        code[hot] = (np.cumsum(kept) - 1)[code[hot]]
        pairs = pairs[kept]
    flat = np.concatenate([np.zeros(0, np.int64), *rules])
    stays = np.r_[0, np.cumsum(live)]
    return np.stack([flat >> 32, flat & 0xFFFFFFFF], axis=1).astype("<u4"), s[:n][live], np.diff(np.r_[0, stays[ends]])


def rule_lengths(rules: np.ndarray, first_rule: int) -> list[int]:
    """How many ids each rule expands to."""
    out: list[int] = []
    for a, b in rules.tolist():
        out.append((out[a - first_rule] if a >= first_rule else 1) + (out[b - first_rule] if b >= first_rule else 1))
    return out


def expand(symbols: np.ndarray, flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The ids of symbols; flat, starts and sizes are those of `unpacked`."""
    return gathered(flat, starts[symbols], sizes[symbols])


def shard_row(part: int, shard: int, doc_ids: list, flat: np.ndarray, tokens: np.ndarray, first_rule: int, rarest: int) -> dict:
    rules, symbols, sizes = compress(flat, np.cumsum(tokens), first_rule, max(2, len(flat) // rarest if rarest else 2))
    width = 2 if first_rule + len(rules) <= 1 << 16 else 4
    return {
        "part": part,
        "shard": shard,
        "doc_ids": doc_ids,
        "n_symbols": sizes.tolist(),
        "n_tokens": tokens.tolist(),
        "n_ids": len(flat),
        "first_rule": first_rule,
        "rules": rules.tobytes(),
        "lengths": np.array(rule_lengths(rules, first_rule), "<u4").tobytes(),
        "symbols": symbols.astype(f"<u{width}").tobytes(),
        "width": width,
    }


def with_ends(flat: np.ndarray, n: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of documents, of which each has n, and `end` after each."""
    out = np.full(len(flat) + len(n), end, "<u4")
    own = np.ones(len(out), bool)
    own[np.cumsum(n + 1) - 1] = False
    out[own] = flat
    return out, n + 1


def write_files(docs: DataFrame, tokenizer: str, folder: str, id_col: str = "doc_id", text_col: str = "text", end: int = END, shard_ids: int = SHARD_IDS, rarest: int = RAREST) -> str:
    """Write the ids of docs, each document with `end` after it, below folder; returns the files' path.

    rarest: a pair is frequent if it is at least one in so many of a shard's, and occurs twice; 0: if it occurs twice.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).repartitionByRange(n, "id").sortWithinPartitions("id", "text").withColumn("part", F.spark_partition_id())
    schema = pa.schema(FILE_FIELDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        first_rule = max(enc.tokenizer.get_vocab_size(), end + 1)
        doc_ids, ids, counts, held, shard, part = [], [], [], 0, 0, 0

        def row() -> pa.RecordBatch:
            made = shard_row(part, shard, doc_ids, np.concatenate(ids), np.concatenate(counts), first_rule, rarest)
            return pa.RecordBatch.from_pylist([made], schema=schema)

        for batch in by_bytes(batches, 1, TEXT_BYTES):
            part = batch.column(2)[0].as_py()
            flat, sizes = with_ends(*enc(batch.column(1)), end)
            own, at = batch.column(0).to_pylist(), 0
            ends = np.cumsum(sizes)
            while at < len(own):  # the shard is closed behind the document that fills it
                before = int(ends[at - 1]) if at else 0
                to = min(int(np.searchsorted(ends, before + shard_ids - held)) + 1, len(own))
                doc_ids += own[at:to]
                ids.append(flat[before : ends[to - 1]])
                counts.append(sizes[at:to])
                held += int(ends[to - 1]) - before
                at = to
                if held >= shard_ids:
                    yield row()
                    doc_ids, ids, counts, held, shard = [], [], [], 0, shard + 1
        if doc_ids:
            yield row()

    path = f"{folder}/ids-{uuid.uuid4().hex}"
    dealt.mapInArrow(run, ", ".join(f"{c} {ddl(t)}" for c, t in FILE_FIELDS)).write.parquet(path)
    return path


def unpacked(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(symbols; what symbols expand to, one after another; where each one's ids start there, and how many they are)."""
    first = row["first_rule"]
    made: list[bytes] = []
    ids = np.arange(first, dtype="<u4")
    said = ids.tobytes()
    for a, b in np.frombuffer(row["rules"], "<u4").reshape(-1, 2).tolist():
        made.append((made[a - first] if a >= first else said[4 * a : 4 * a + 4]) + (made[b - first] if b >= first else said[4 * b : 4 * b + 4]))
    sizes = np.r_[np.ones(first, np.int64), np.frombuffer(row["lengths"], "<u4").astype(np.int64)]
    flat = np.concatenate([ids, np.frombuffer(b"".join(made), "<u4")])
    return np.frombuffer(row["symbols"], f"<u{row['width']}"), flat, np.cumsum(sizes) - sizes, sizes


def document_ids(row: dict, k: int, start: int = 0, stop: int | None = None) -> np.ndarray:
    """Ids start to stop of the k-th document of a shard; only the symbols that hold them are expanded."""
    symbols, flat, starts, sizes = unpacked(row)
    at = sum(row["n_symbols"][:k])
    own = symbols[at : at + row["n_symbols"][k]]
    ends = np.cumsum(sizes[own])
    stop = row["n_tokens"][k] if stop is None else min(stop, row["n_tokens"][k])
    a, b = int(np.searchsorted(ends, start, "right")), int(np.searchsorted(ends, stop, "left")) + 1
    before = int(ends[a - 1]) if a else 0
    return expand(own[a:b], flat, starts, sizes)[start - before : max(start, stop) - before]


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """For each document in the files: doc_id, start (ids before it), n_tokens and ids_crc32 of its decoded ids."""
    files = spark.read.schema(", ".join(f"{c} {ddl(t)}" for c, t in FILE_FIELDS)).parquet(path)
    fields = [("part", pa.int32()), ("shard", pa.int32()), ("doc_id", pa.int64()), ("at", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                (row,) = batch.slice(k, 1).to_pylist()
                ids = expand(*unpacked(row))
                ends = np.cumsum(row["n_tokens"])
                n = len(ends)
                crc = [zlib.crc32(ids[e - t : e]) for e, t in zip(ends.tolist(), row["n_tokens"])]
                cols = [[row["part"]] * n, [row["shard"]] * n, row["doc_ids"], ends - row["n_tokens"], row["n_tokens"], crc]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, fields)], schema=schema)

    decoded = files.mapInArrow(run, ", ".join(f"{c} {ddl(t)}" for c, t in fields))
    # Sums in two levels: one row for each range of ids, and one for each shard in it.
    sizes = files.select("part", "shard", "n_ids")
    before = lambda w: F.coalesce(F.sum("n_ids").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n_ids")).select("part", before(Window.orderBy("part")).alias("p"))
    shards = sizes.select("part", "shard", before(Window.partitionBy("part").orderBy("shard")).alias("s")).join(parts, "part")
    return decoded.join(shards, ["part", "shard"]).select("doc_id", (F.col("p") + F.col("s") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
