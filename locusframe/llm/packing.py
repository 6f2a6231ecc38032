"""Packing of tokenised documents into sequences of bounded length.

Documents are tokenised once. Only documents longer than a sequence are cut. The rest is packed in
groups: best fit, longest first, then a local search that moves documents, exchanges one for one or
two for one between underfull sequences, each step raising the sum of squared fills, until the
emptiest sequences are gone. What stays underfull in all groups is packed again together.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusframe.llm.common import stored

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


class Vocabulary(dict):
    """Token ids, as little-endian unsigned 32-bit bytes, of the strings between white space.

    The tokenizer never joins across white space, nor a run of letters with the punctuation behind it,
    so a text's ids are those of such parts one after another. A new string gets an empty place, which ``learn`` fills
    for many strings at a time. Strings not met for a while are forgotten, others are kept. A worker process has it in memory
    between tasks and stages too: about ``limit`` strings, letter runs among them, are all that it holds.
    """

    limit = 450_000
    _parts = re.compile(rb"^(?:([a-z\x80-\xff]+)([!-&(-/:-@\[-`{-~]*)$|.+$)", re.MULTILINE)

    def __init__(self, name: str):
        import os

        import public_tokenizers
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        super().__init__()
        self.tokenizer = Tokenizer.from_file(name if "/" in name else public_tokenizers.path(name))
        suffix, known = getattr(self.tokenizer.model, "end_of_word_suffix", None), self.tokenizer.get_vocab()
        self.ends = np.zeros(max(known.values(), default=-1) + 1, bool)
        self.ends[[i for token, i in known.items() if suffix and token.endswith(suffix)]] = True
        self.older: dict[bytes, bytes] = {}
        self.unknown: dict[bytes, bytearray] = {}
        self.marks: dict[bytes, bytes] = {b"": b""}

    def __missing__(self, word: bytes) -> bytes | bytearray:
        ids = self.older.get(word)
        if ids is not None:
            self[word] = ids
            return ids
        return self.unknown.setdefault(word, bytearray())

    @staticmethod
    def split(text: str | None) -> list[bytes]:
        """Strings between white space; in lower case, as the tokenizer makes it, unless a special token may be among them."""
        coded = (text or "").encode("utf-8")
        return (coded if b"<|" in coded else coded.lower()).split()

    def ids(self, texts: list[str | None]) -> list[bytes]:
        """The ids of every text."""
        parts = [list(map(self.__getitem__, self.split(t))) for t in texts]
        self.learn()
        return list(map(b"".join, parts))

    def encode(self, text: bytes) -> bytes:
        return np.array(self.tokenizer.encode(text.decode("utf-8"), add_special_tokens=False).ids, "<u4").tobytes()

    def learn(self) -> None:
        """Fill the places of the strings that were not known."""
        if 2 * len(self) > self.limit:
            self.older = dict(self)
            self.clear()
            self.marks = {b"": b""}
        split = self._parts.findall(b"\n".join(self.unknown).lower())
        runs = {run: self.get(run) or self.older.get(run) for run, _ in split if run and (run.isascii() or _letters(run.decode("utf-8")))}
        fresh = [run for run, ids in runs.items() if not ids]
        for at in range(0, len(fresh), 1000):
            self._learn_runs(fresh[at : at + 1000], runs)
        self.update(runs)
        for (word, place), (run, mark) in zip(self.unknown.items(), split):
            ids = runs.get(run)  # none for what is not of letters only
            if ids is None:
                ids = self.encode(word)
            elif mark:
                if mark not in self.marks:
                    self.marks[mark] = self.encode(mark)
                ids += self.marks[mark]
            place += ids
            self[word] = ids
        self.unknown.clear()

    def _learn_runs(self, runs: list[bytes], found: dict[bytes, bytes]) -> None:
        """Encode letter runs as one text, told apart by the tokens that end a word; one by one should these not agree."""
        numbers = np.array(self.tokenizer.encode_batch_fast([b" ".join(runs).decode("utf-8")], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(self.ends[numbers]) + 1
        if len(ends) != len(runs) or ends[-1] != len(numbers):
            found.update((r, self.encode(r)) for r in runs)
            return
        ids, ends = numbers.tobytes(), (4 * ends).tolist()
        found.update((r, ids[a:b]) for r, a, b in zip(runs, [0, *ends], ends))


def _letters(text: str) -> bool:
    """Whether a text has nothing but letters, also as the tokenizer normalises it."""
    return not text or text.isalpha() and unicodedata.normalize("NFC", text).lower().isalpha()


_vocabularies: dict[str, Vocabulary] = {}


def vocabulary(name: str) -> Vocabulary:
    if name not in _vocabularies:
        _vocabularies[name] = Vocabulary(name)
    return _vocabularies[name]


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, id_col: str = "doc_id", text_col: str = "text", step: int = 256) -> DataFrame:
    """Pieces of at most ``capacity`` ids of every document: (doc_id, piece, start, length, ids_crc32)."""
    closing = np.array([end_id], "<u4").tobytes()

    def run(batches):
        words = vocabulary(tokenizer)
        kinds = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
        for batch in batches:
            for at in range(0, batch.num_rows, step):  # the texts of a step are all that Python holds
                part, out = batch.slice(at, step), []
                for doc, ids in zip(part.column(id_col).to_pylist(), words.ids(part.column(text_col).to_pylist())):
                    ids += closing
                    for piece, first in enumerate(range(0, len(ids), 4 * capacity)):
                        body = ids[first : first + 4 * capacity]
                        out.append((doc, piece, first // 4, len(body) // 4, zlib.crc32(body)))
                yield pa.RecordBatch.from_arrays([pa.array(column, kind.type) for column, kind in zip(zip(*out), kinds)], schema=kinds)

    return docs.select(F.col(id_col).cast("long").alias(id_col), text_col).mapInArrow(run, PIECES)


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of indexes: longest first, each into the fullest bin that takes it."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r: some bin has r left
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        n = lengths[i]
        fits = rooms >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, b = capacity, len(bins)
            bins.append([])
        bins[b].append(i)
        left = room - n
        by_room[left].append(b)
        rooms |= 1 << left
    return bins


def improve(bins: list[list[int]], lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Local search: moves and one-for-one or two-for-one exchanges from the emptiest bins into fuller ones.

    Every step raises the sum of squared fills, so the search ends; it also ends when no packing can have fewer bins.
    """
    lengths = np.asarray(lengths, np.int64)
    least = -(-int(lengths.sum()) // capacity)
    where = np.empty(len(lengths), np.int64)
    for b, items in enumerate(bins):
        where[items] = b
    fill = np.array([int(lengths[items].sum()) for items in bins], np.int64)
    alive = int((fill > 0).sum())
    moved = True
    while moved and alive > least:
        moved = False
        open_bins = np.flatnonzero((fill > 0) & (fill < capacity))
        sources = open_bins[np.argsort(fill[open_bins], kind="stable")][: 4 * (alive - least) + 8]
        for s in sources:
            while alive > least and fill[s] > 0:
                if not _step(int(s), bins, where, lengths, fill, capacity):
                    break
                moved = True
                alive = int((fill > 0).sum())
    return [items for items in bins if items]


def _step(s: int, bins, where, lengths, fill, capacity) -> bool:
    """One improving step out of bin s; false if there is none."""
    others = (fill >= fill[s]) & (fill < capacity)
    others[s] = False
    if not others.any():
        return False
    room = capacity - fill
    for i in sorted(bins[s], key=lambda i: -lengths[i]):
        fits = np.flatnonzero(others & (room >= lengths[i]))
        if len(fits):
            t = int(fits[np.argmin(room[fits])])
            _exchange(s, t, [i], [], bins, where, lengths, fill)
            return True
    inside = np.flatnonzero(others[where])
    gives = [(int(lengths[i]), (i,)) for i in bins[s]]
    gives += [(int(lengths[i] + lengths[j]), (i, j)) for i, j in combinations(bins[s], 2)]
    size, space = lengths[inside], room[where[inside]]
    for n, items in sorted(gives, reverse=True):
        gain = n - size
        good = (gain > 0) & (gain <= space)
        if good.any():
            k = int(np.argmax(np.where(good, gain, -1)))
            back = int(inside[k])
            _exchange(s, int(where[back]), list(items), [back], bins, where, lengths, fill)
            return True
    return False


def _exchange(s, t, there, back, bins, where, lengths, fill) -> None:
    for a, b, items in ((s, t, there), (t, s, back)):
        for i in items:
            bins[a].remove(i)
            bins[b].append(i)
            where[i] = b
            fill[a] -= lengths[i]
            fill[b] += lengths[i]


def _pack(capacity: int, rounds: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "row"], ascending=[False, True], kind="stable").reset_index(drop=True)
        lengths = pdf["length"].to_numpy(np.int64)
        bins = improve(best_fit(lengths.tolist(), capacity), lengths, capacity)
        seq, offset, fill = np.empty(len(pdf), np.int64), np.empty(len(pdf), np.int64), np.empty(len(pdf), np.int64)
        base = (rounds << 56) + (int(pdf["part"].iat[0]) << 20)
        for b, items in enumerate(bins):
            n = lengths[items]
            seq[items], offset[items], fill[items] = base + b, np.cumsum(n) - n, n.sum()
        return pdf.assign(sequence_id=seq, offset=offset, fill=fill)[PACKED]

    return run


PACKED = ["doc_id", "piece", "start", "length", "ids_crc32", "row", "sequence_id", "offset", "fill"]
PACKED_SCHEMA = PIECES + ", row bigint, sequence_id bigint, offset bigint, fill bigint"


def pack(pieces: DataFrame, capacity: int, group_rows: int = 4096, full: float = 0.97) -> DataFrame:
    """Give each piece a sequence and its place there: adds sequence_id and offset.

    Pieces as long as a sequence have one of their own. Groups are drawn by row, not by document, so no key makes
    one large. Sequences filled below ``full`` of the capacity in any group are dissolved and packed again
    together, until one group holds them all or a round no longer lowers their number.
    """
    pieces = stored(pieces.withColumn("row", F.monotonically_increasing_id()))
    done = pieces.where(F.col("length") >= capacity).withColumns({"sequence_id": -1 - F.col("row"), "offset": F.lit(0).cast("long"), "fill": F.col("length")})
    rest, rounds, last = pieces.where(F.col("length") < capacity), 0, None
    parts = [done.select(*PACKED)]
    while True:
        count = rest.count()
        if count == 0:
            break
        groups = -(-count // group_rows)
        packed = rest.withColumn("part", F.pmod(F.xxhash64("row", F.lit(rounds)), F.lit(groups)).cast("int")).groupBy("part").applyInPandas(_pack(capacity, rounds), PACKED_SCHEMA)
        packed = stored(packed)
        rounds += 1
        if groups == 1 or count == last:
            parts.append(packed)
            break
        loose = F.col("fill") < int(full * capacity)
        parts.append(packed.where(~loose))
        rest, last = packed.where(loose).drop("sequence_id", "offset", "fill"), count
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.drop("row", "fill")


def pack_documents(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents with their sequence: (doc_id, piece, start, length, ids_crc32, sequence_id, offset).

    A null or empty text is the end id alone. Repeated rows are packed each; a null id keeps its row.
    An empty table gives no rows. ``tokenizer`` is a file name of the public tokenizers or a path. Long texts are cut into
    pieces of ``capacity``. Other columns of the input, whatever their names, are neither read nor returned.
    """
    return pack(token_pieces(docs, tokenizer, capacity, end_id, id_col, text_col), capacity).withColumnRenamed("doc_id", id_col)
