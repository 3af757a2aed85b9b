"""Byte-level BPE encoding and decoding as Spark jobs, from a tokenizer file of the
tokenizers library (``vocab``, ``merges``, ``added_tokens``), never trained here.

Method: the merges are compiled once, on the driver, into transition tables - for every
pair of token ids that a merge joins, the merge's rank and the id it leads to; for every
byte, its start id; for every id, the bytes it stands for. The tables have the size of the
vocabulary file (a fixed bound) and are broadcast. Executors then encode Arrow batches of
texts: a text is split at the added (special) tokens, the rest pre-split by the pattern,
and each pre-split word runs through the tables - the pair of lowest rank, leftmost first,
is replaced by its target until no pair has a transition. Words of up to SHORT bytes keep
a list of pair values updated at the two neighbours of each merge; longer ones keep a heap over the pairs and links between neighbours,
n log n for a word of n bytes, so a word of a megabyte is no worse than many short ones. Decoding emits the bytes of each id's label and reads them
as UTF-8 (invalid sequences as U+FFFD, as the library does).

This is the merge table used as a transition table; a single automaton composed of one
gadget per merge was not built (see the README).

Edge cases: a null text encodes as an empty text (no ids) and decodes to ""; empty and very
long texts are encoded whole; special-token strings inside a text are that token, as in the
library's default; repeated rows give repeated results; null ids decode to null. Extra
columns are dropped, also when their names clash.
"""

from __future__ import annotations

import heapq
import json

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sparkwright.session import ship_package

SHIFT = 20
LOW = (1 << SHIFT) - 1
CACHE_WORDS = 200_000
SHORT = 64
NONE = 1 << 62


def _byte_chars() -> list[str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for the
    code points from 256 on, in byte order."""
    kept = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    chars, extra = {}, 0
    for b in range(256):
        if b in kept:
            chars[b] = chr(b)
        else:
            chars[b] = chr(256 + extra)
            extra += 1
    return [chars[b] for b in range(256)]


def compile_tables(path: str) -> dict:
    """Transition tables of a tokenizer file: start id of each byte, (left << 20 | right)
    -> (rank << 20 | target) for every merge, the bytes of every id, the added tokens."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    vocab = model["vocab"]
    chars = _byte_chars()
    back = {c: b for b, c in enumerate(chars)}
    start = [vocab[c] for c in chars]
    steps = {}
    for rank, merge in enumerate(model["merges"]):
        a, b = merge.split(" ", 1) if isinstance(merge, str) else merge
        key = vocab[a] << SHIFT | vocab[b]
        if key not in steps:
            steps[key] = rank << SHIFT | vocab[a + b]
    size = max(vocab.values()) + 1
    added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    size = max([size, *(i + 1 for i in added.values())])
    labels = [b""] * size
    for token, i in vocab.items():
        labels[i] = bytes(back[c] for c in token)
    for content, i in added.items():
        labels[i] = content.encode("utf-8")
    return {"start": start, "steps": steps, "labels": labels, "added": added}


class Encoder:
    """Encodes and decodes with compiled tables; words seen before come from a cache."""

    def __init__(self, tables: dict, pattern: str):
        self.start = tables["start"]
        self.steps = tables["steps"]
        self.labels = tables["labels"]
        self.added = tables["added"]
        self.split = regex.compile(pattern)
        specials = sorted(self.added, key=len, reverse=True)
        self.specials = regex.compile("|".join(regex.escape(s) for s in specials)) if specials else None
        self.cache: dict[bytes, list[int]] = {}

    def word(self, text: str) -> list[int]:
        known = self.cache.get(text)
        if known is not None:
            return known
        ids = [self.start[b] for b in text.encode("utf-8")]
        n = len(ids)
        if 1 < n <= SHORT:
            # Short words: a list of packed pair values (rank << 20 | target, NONE where no
            # merge applies); min and index run in C, and the leftmost of equal values is
            # the leftmost occurrence of that pair. A merge updates its two neighbours.
            get = self.steps.get
            r = [get(ids[i] << SHIFT | ids[i + 1], NONE) for i in range(n - 1)]
            while r:
                best = min(r)
                if best == NONE:
                    break
                at = r.index(best)
                new = best & LOW
                ids[at] = new
                del ids[at + 1]
                del r[at]
                if at > 0:
                    r[at - 1] = get(ids[at - 1] << SHIFT | new, NONE)
                if at < len(ids) - 1:
                    r[at] = get(new << SHIFT | ids[at + 1], NONE)
        elif n > SHORT:
            steps = self.steps
            nxt = list(range(1, n + 1))
            nxt[-1] = -1
            prev = list(range(-1, n - 1))
            alive = [True] * n
            heap = []
            for i in range(n - 1):
                t = steps.get(ids[i] << SHIFT | ids[i + 1])
                if t is not None:
                    heap.append((t >> SHIFT, i, ids[i], ids[i + 1]))
            heapq.heapify(heap)
            while heap:
                _, i, a, b = heapq.heappop(heap)
                j = nxt[i]
                if not alive[i] or j < 0 or ids[i] != a or ids[j] != b:
                    continue
                new = steps[a << SHIFT | b] & LOW
                ids[i] = new
                alive[j] = False
                k = nxt[j]
                nxt[i] = k
                if k >= 0:
                    prev[k] = i
                    t = steps.get(new << SHIFT | ids[k])
                    if t is not None:
                        heapq.heappush(heap, (t >> SHIFT, i, new, ids[k]))
                p = prev[i]
                if p >= 0:
                    t = steps.get(ids[p] << SHIFT | new)
                    if t is not None:
                        heapq.heappush(heap, (t >> SHIFT, p, ids[p], new))
            ids = [x for x, keep in zip(ids, alive) if keep]
        if len(self.cache) >= CACHE_WORDS:
            self.cache.clear()
        self.cache[text] = ids
        return ids

    def _plain(self, text: str, out: list[int]) -> None:
        cache, word = self.cache, self.word
        for piece in self.split.findall(text):
            known = cache.get(piece)
            out.extend(known if known is not None else word(piece))

    def encode(self, text: str | None, out: list[int] | None = None) -> list[int]:
        """The ids of ``text``, appended to ``out`` if given."""
        out = [] if out is None else out
        if not text:
            return out
        at = 0
        if self.specials is not None:
            for m in self.specials.finditer(text):
                self._plain(text[at : m.start()], out)
                out.append(self.added[m.group()])
                at = m.end()
        self._plain(text[at:], out)
        return out

    def decode(self, ids) -> str | None:
        if ids is None:
            return None
        return b"".join(map(self.labels.__getitem__, ids)).decode("utf-8", "replace")


def _pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def _default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


_ENCODERS: dict = {}


def _encoder(tables, pattern: str) -> Encoder:
    key = (id(tables), pattern)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(tables.value, pattern)
    return _ENCODERS[key]


def _broadcast(spark, path: str | None):
    ship_package(spark)
    return spark.sparkContext.broadcast(compile_tables(path or _default_path()))


PIECE_BYTES = 4 << 20


def _slices(batch: pa.RecordBatch, column: int, size_of):
    """Slices of a batch holding at most PIECE_BYTES by ``size_of``, a larger row alone;
    the Python objects of one slice are all that live at once."""
    sizes = size_of(batch.column(column))
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if total and total + size > PIECE_BYTES:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += int(size)
    if start < batch.num_rows:
        yield batch.slice(start)


def _text_bytes(texts: pa.Array):
    return pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)


def _id_bytes(ids: pa.Array):
    return pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False) * 4


def _encoded(enc: Encoder, texts: list) -> pa.Array:
    """One list<int32> array from flat buffers: offsets and values, no list per text."""
    flat: list[int] = []
    offsets = [0]
    for t in texts:
        enc.encode(t, flat)
        offsets.append(len(flat))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))


def encode(
    docs: DataFrame, path: str | None = None, pattern: str | None = None,
    id_col: str = "doc_id", text_col: str = "text", with_decoded: bool = False,
) -> DataFrame:
    """(doc_id, ids array<int>) for every row of ``docs``; with ``with_decoded`` also the
    decoded text, in the same pass. Batches are worked in slices of bounded text."""
    spark = docs.sparkSession
    tables, pattern = _broadcast(spark, path), pattern or _pattern()
    fields = [("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))] + ([("decoded", pa.string())] if with_decoded else [])
    out = pa.schema(fields)

    def run(batches):
        enc = _encoder(tables, pattern)
        for batch in batches:
            for part in _slices(batch, 1, _text_bytes):
                ids = _encoded(enc, part.column(1).to_pylist())
                columns = [part.column(0), ids]
                if with_decoded:
                    offsets = ids.offsets.to_numpy()
                    values = ids.values.to_numpy(zero_copy_only=False).tolist()
                    columns.append(pa.array(
                        [enc.decode(values[offsets[i]:offsets[i + 1]]) for i in range(len(ids))], pa.string()
                    ))
                yield pa.RecordBatch.from_arrays(columns, schema=out)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ddl = "doc_id long, ids array<int>" + (", decoded string" if with_decoded else "")
    return rows.mapInArrow(run, ddl)


def decode(encoded: DataFrame, path: str | None = None, ids_col: str = "ids") -> DataFrame:
    """Adds ``decoded`` (string) to a table with a column of ids."""
    spark = encoded.sparkSession
    tables = _broadcast(spark, path)
    schema = StructType([*encoded.schema.fields, StructField("decoded", StringType())])
    at = encoded.columns.index(ids_col)

    def run(batches):
        enc = _encoder(tables, "")
        for batch in batches:
            for part in _slices(batch, at, _id_bytes):
                texts = [enc.decode(ids) for ids in part.column(at).to_pylist()]
                yield part.append_column("decoded", pa.array(texts, pa.string()))

    return encoded.mapInArrow(run, schema)
