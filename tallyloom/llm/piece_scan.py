"""SentencePiece encoding and decoding with a max-plus parallel scan for giant documents.

The vocabulary file's pieces and scores are read as a unigram model: a text's ids are the segmentation with the largest
sum of scores (ties: the longest last piece, from the end of the text backwards). As in the library, a space becomes the
mark U+2581 with one before the text, a character no piece covers costs ten below the least score and is spelled in
byte pieces. Scores are whole numbers, so sums are exact whatever the order.

**Ordinary texts.** No piece but a run of marks has a mark inside, so every best segmentation cuts before
each run of marks; each unit between two such cuts is solved once per bounded table, by the Unigram model of the
``tokenizers`` package over the same pieces and scores: it settles ties and unknown characters alike.

**Giant texts** are cut into chunks of ``CHUNK`` characters anywhere. A chunk's *boundary state* is how far the first cut
at or after the boundary lies behind it (less than the longest piece). Pass 1 gives for each chunk the *transfer matrix*:
the best score of its pieces from each entering to each leaving state. Matrices combine associatively in max-plus
algebra; the combined prefixes fix the state at every boundary. Pass 2 traces each chunk back between its two states,
independently of all others. A matrix is a few hundred numbers per ``CHUNK`` characters, so the scan of one document holds a
small share of its text. The score is the same as without chunks; only between equally good segmentations may a boundary
choose another one (the earliest cut).

Decoding joins pieces, byte pieces as UTF-8 (broken bytes become U+FFFD), turns marks to spaces and drops the first one.
A text that holds the mark itself decodes with spaces there, as in the library. Null and empty texts have no ids and
decode to the empty text. Repeated rows are encoded each.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from tallyloom.llm.common import Known, vocabulary_path
from tallyloom.sources.workspace import stage

VOCABULARY = "piece_bpe_32k.model"
CHUNK = 1 << 15
UNITS_KEPT = 120_000
# Bytes of ids after which a task hands rows on.
BATCH_BYTES = 1 << 22
MARK = "▁"
UNKNOWN_PENALTY = 10
FINAL_MARKS = ".,;:!?*#$%&|"
UNIT = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
LOW = -(1 << 60)


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Vocabulary:
    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.names = [model.id_to_piece(i) for i in range(model.vocab_size())]
        self.bytes = {int(name[3:5], 16): i for i, name in enumerate(self.names) if model.is_byte(i)}
        self.byte_of = {i: byte for byte, i in self.bytes.items()}
        self.silent = {i for i in range(len(self.names)) if model.is_control(i)}
        self.unknown = model.unk_id()
        # An ASCII byte is a character of its own whatever stands beside it; the other ids cannot simply be joined.
        self.texts = [chr(self.byte_of[i]) if self.byte_of.get(i, 128) < 128 else name for i, name in enumerate(self.names)]
        self.unlike = np.zeros(len(self.names), dtype=bool)
        self.unlike[[*(i for i, byte in self.byte_of.items() if byte > 127), *self.silent, self.unknown]] = True
        plain = [i for i in range(len(self.names)) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        self.pieces = {self.names[i]: (round(model.get_score(i)), i) for i in plain}
        self.longest = max(map(len, self.pieces))
        self.lost = min(score for score, _ in self.pieces.values()) - UNKNOWN_PENALTY
        self.ids = Known(self.solve_unit)
        self.scores = Known(self.score_unit)
        joined = {b for piece in self.pieces for a, b in zip(piece, piece[1:]) if a.isalnum()}
        self.apart = set(FINAL_MARKS) - joined

    # Only workers that encode build what follows, and only those with giant texts all of it.

    @cached_property
    def beginnings(self) -> dict[str, int]:
        """Every beginning of a piece, with the score where it is one itself."""
        found = {piece[:k]: LOW for piece in self.pieces for k in range(1, len(piece))}
        found.update((piece, score) for piece, (score, _) in self.pieces.items())
        return found

    @cached_property
    def unigram(self):
        """Place 0 stands for what no piece covers; its name holds a space, which no marked text has."""
        from tokenizers.models import Unigram

        listed = [(f"{MARK} {MARK}", 0.0), *((piece, float(score)) for piece, (score, _) in self.pieces.items())]
        return Unigram(listed, 0, False)

    @cached_property
    def numbers(self) -> list[bytes]:
        """Packed id by place in the unigram model."""
        return [b"", *(packed([i]) for _, i in self.pieces.values())]

    @cached_property
    def gains(self) -> list[int]:
        """Score by place in the unigram model."""
        return [0, *(score for score, _ in self.pieces.values())]

    def spelled(self, char: str) -> list[int]:
        """Ids of a character that is no piece."""
        if not self.bytes:
            return [self.unknown]
        return [self.bytes[b] for b in char.encode("utf-8", "surrogatepass")]

    def best(self, text: str, begin: int, end: int, limit: int | None = None) -> tuple[list[int], list[int]]:
        """Best score of each position from a cut at ``begin``, and the start of its last piece.

        Pieces start before ``limit``. Lists are counted from ``begin``.
        """
        limit = end if limit is None else limit
        score, back = [0] + [LOW] * (end - begin), [-1] * (end - begin + 1)
        begins = self.beginnings.get
        for start in range(begin, min(limit, end)):
            so_far = score[start - begin]
            if so_far == LOW:
                continue
            covered = False
            for at in range(start + 1, min(end, start + self.longest) + 1):
                gain = begins(text[start:at])
                if gain is None:
                    break
                if gain != LOW:
                    covered = covered or at == start + 1
                    if so_far + gain > score[at - begin]:
                        score[at - begin], back[at - begin] = so_far + gain, start
            if not covered and so_far + self.lost > score[start + 1 - begin]:
                score[start + 1 - begin], back[start + 1 - begin] = so_far + self.lost, start
        return score, back

    def trace(self, text: str, begin: int, end: int, back: list[int]) -> list[int]:
        pieces = []
        while end > begin:
            start = back[end - begin]
            piece = self.pieces.get(text[start:end])
            pieces.append([piece[1]] if piece else self.spelled(text[start:end]))
            end = start
        return [i for each in reversed(pieces) for i in each]

    def solve_unit(self, unit: str, known: Known) -> bytes:
        """Ids of a unit that lies between two certain cuts."""
        core = self.core(unit)
        if len(core) < len(unit):
            return known[core] + known[unit[len(core) :]]
        tokens = self.unigram.tokenize(unit)
        return b"".join(
            [self.numbers[t.id] if t.id else packed([i for c in t.value for i in self.spelled(c)]) for t in tokens]
        )

    def score_unit(self, unit: str, known: Known) -> int:
        core = self.core(unit)
        if len(core) < len(unit):
            return known[core] + known[unit[len(core) :]]
        tokens = self.unigram.tokenize(unit)
        return sum(self.gains[t.id] if t.id else self.lost * len(t.value) for t in tokens)

    def core(self, unit: str) -> str:
        """The unit without its final marks, if no piece can span the place before them."""
        core = unit.rstrip(FINAL_MARKS)
        return core if core and core != unit and core[-1].isalnum() and unit[len(core)] in self.apart else unit

    def encode(self, text: str) -> bytes:
        """Ids of a marked text."""
        self.ids, self.scores = self.ids.renewed(UNITS_KEPT), self.scores.renewed(UNITS_KEPT // 4)
        return b"".join(map(self.ids.__getitem__, UNIT.findall(text)))

    def score(self, text: str) -> int:
        """Score of a marked text that begins and ends at a certain cut."""
        return sum(map(self.scores.__getitem__, UNIT.findall(text)))

    # --- chunks -----------------------------------------------------------------------------------------------

    def certain_cuts(self, text: str, size: int) -> tuple[int, int]:
        """The first certain cut that every entering state has reached, and the last one; -1 if there is none."""
        cuts = [m.start() for m in re.finditer(f"(?<!{MARK}){MARK}", text) if self.longest <= m.start() < size]
        return (cuts[0], cuts[-1]) if cuts else (-1, -1)

    def transfer(self, text: str, size: int) -> np.ndarray:
        """Best scores [entering, leaving] of a chunk: ``size`` characters and those that pieces may reach beyond."""
        states = self.longest
        out = np.full((states, states), LOW, dtype=np.int64)
        first, last = self.certain_cuts(text, size)
        if first < 0:
            for enter in range(min(states, len(text) + 1)):
                if enter >= size:
                    # The piece that enters reaches beyond the whole chunk.
                    if enter - size < states:
                        out[enter, enter - size] = 0
                    continue
                score, _ = self.best(text, enter, len(text), size)
                reached = [score[at - enter] if at >= enter else LOW for at in range(size, len(text) + 1)]
                out[enter, : len(reached)] = reached[:states]
            return out
        middle = self.score(text[first:last])
        tail, _ = self.best(text, last, len(text), size)
        leave = np.full(states, LOW, dtype=np.int64)
        reached = tail[size - last : size - last + states]
        leave[: len(reached)] = reached
        for enter in range(states):
            head = self.best(text, enter, first)[0][-1]
            if head > LOW:
                out[enter] = np.where(leave > LOW, leave + head + middle, LOW)
        return out

    def between(self, text: str, size: int, enter: int, leave: int) -> bytes:
        """Ids of the pieces that start in a chunk, on the best way from one state to another."""
        first, last = self.certain_cuts(text, size)
        if enter >= size:
            return b""
        if first < 0:
            _, back = self.best(text, enter, size + leave, size)
            return packed(self.trace(text, enter, size + leave, back))
        _, head = self.best(text, enter, first)
        _, tail = self.best(text, last, size + leave, size)
        return (
            packed(self.trace(text, enter, first, head))
            + self.encode(text[first:last])
            + packed(self.trace(text, last, size + leave, tail))
        )

    def decode(self, ids: np.ndarray) -> str:
        if not self.unlike[ids].any():
            return "".join(map(self.texts.__getitem__, ids.tolist())).replace(MARK, " ").removeprefix(" ")
        out: list[str] = []
        held = bytearray()
        for i in ids.tolist():
            byte = self.byte_of.get(i)
            if byte is not None:
                held.append(byte)
                continue
            if held:
                out.append(held.decode("utf-8", "replace"))
                held.clear()
            if i not in self.silent:
                out.append(" ⁇ " if i == self.unknown else self.names[i])
        out.append(held.decode("utf-8", "replace"))
        return "".join(out).replace(MARK, " ").removeprefix(" ")


@lru_cache(maxsize=2)
def vocabulary(path: str | None = None) -> Vocabulary:
    return Vocabulary(path or vocabulary_path(VOCABULARY))


def in_parts(batch: pa.RecordBatch, ids_of) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Slices of a batch with the ids of their rows, about ``BATCH_BYTES`` of ids each: one text at a time is a Python object."""
    found, size, begin = [], 0, 0
    for row in zip(*batch.columns):
        found.append(ids_of(row))
        size += len(found[-1])
        if size >= BATCH_BYTES:
            yield batch.slice(begin, len(found)), pa.array(found, pa.binary())
            begin, found, size = begin + len(found), [], 0
    if found:
        yield batch.slice(begin), pa.array(found, pa.binary())


def marked(text: str | None) -> str:
    return MARK + text.replace(" ", MARK) if text else ""


def combine(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Max-plus product of two transfer matrices; associative."""
    total = (left[:, :, None] + right[None, :, :]).max(axis=1)
    return np.where(total < LOW // 2, LOW, total)


def boundary_states(matrices: list[np.ndarray]) -> list[int]:
    """Entering state of every chunk and the final one (0): the best way through all of them."""
    state = np.full(len(matrices[0]), LOW, dtype=np.int64)
    state[0] = 0
    reached = [state]
    for each in matrices:
        reached.append(combine(reached[-1][None, :], each)[0])
    states = [0]
    for before, each in zip(reversed(reached[:-1]), reversed(matrices)):
        states.append(int((before + each[:, states[-1]]).argmax()))
    return states[::-1]


def chunked(docs: DataFrame, text: str, size: int, path: str | None) -> DataFrame:
    """``__row, chunk, last, part, transfer``: the chunks of giant texts with their transfer matrices."""
    kinds = [("chunk", pa.int64()), ("last", pa.bool_()), ("part", pa.string()), ("transfer", pa.binary())]
    schema = "__row long, chunk long, last boolean, part string, transfer binary"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:
            for row, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                whole, rows = marked(raw.as_py()), []
                for start in range(0, len(whole), size):
                    part = whole[start : start + size + words.longest - 1]
                    matrix = words.transfer(part, min(size, len(whole) - start))
                    rows.append((start // size, start + size >= len(whole), part, matrix.tobytes()))
                columns = [pa.array(column, kind) for column, (_, kind) in zip(zip(*rows), kinds)]
                rows_of = pa.array([row] * len(rows), pa.int64())
                yield pa.RecordBatch.from_arrays([rows_of, *columns], names=["__row", *[name for name, _ in kinds]])

    return docs.select("__row", text).mapInArrow(work, schema)


def encode(
    docs: DataFrame,
    text: str = "text",
    ids: str = "ids",
    size: int = CHUNK,
    path: str | None = None,
    decoded: str | None = None,
) -> DataFrame:
    """``docs`` with ``ids``: little-endian unsigned 32-bit numbers. Only texts of ``size`` characters or more are
    written and shuffled, as chunks. A name for ``decoded`` adds what the ids decode to, for ordinary texts without a second
    Python worker."""
    if size < 64:
        raise ValueError("chunks must be longer than any piece")

    place = docs.columns.index(text)

    def whole_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:
            for rows, found in in_parts(batch, lambda row: words.encode(marked(row[place].as_py()))):
                more = [decoded_texts(words, found)] if decoded else []
                yield pa.RecordBatch.from_arrays([*rows.columns, found, *more], names=names)

    long = F.coalesce(F.char_length(text) >= size, F.lit(False))
    added = [StructField(ids, BinaryType()), *([StructField(decoded, StringType())] if decoded else [])]
    names = [*docs.columns, *(field.name for field in added)]
    # Not a column function: those are evaluated again inside each function that reads them.
    ordinary = docs.where(~long).mapInArrow(whole_texts, StructType([*docs.schema.fields, *added]))
    giant = stage(docs.where(long).withColumn("__row", F.monotonically_increasing_id()), "pieces")
    chunks = stage(chunked(giant, text, size, path), "pieces")

    def scan(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("chunk")
        matrices = [np.frombuffer(m, dtype=np.int64) for m in rows["transfer"]]
        matrices = [m.reshape(round(len(m) ** 0.5), -1) for m in matrices]
        states = boundary_states(matrices)
        return pd.DataFrame({"__row": rows["__row"], "chunk": rows["chunk"], "enter": states[:-1], "leave": states[1:]})

    states = chunks.select("__row", "chunk", "transfer").groupBy("__row").applyInPandas(
        scan, "__row long, chunk long, enter int, leave int"
    )

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:

            def traced(row: tuple) -> bytes:
                part, last, enter, leave = (each.as_py() for each in row[2:])
                return words.between(part, len(part) if last else min(size, len(part)), enter, leave)

            for rows, found in in_parts(batch, traced):
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), found], names=["__row", "chunk", "__ids"])

    traced = chunks.select("__row", "chunk", "part", "last").join(states, ["__row", "chunk"])
    traced = traced.select("__row", "chunk", "part", "last", "enter", "leave")
    traced = traced.mapInArrow(trace, "__row long, chunk long, __ids binary")
    # A document's chunks are as long as its own ids, which must fit a cell anyway.
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("chunk", "__ids"))), lambda c: F.hex(c["__ids"]))
    whole = traced.groupBy("__row").agg(F.unhex(F.array_join(ordered, "")).alias(ids))
    solved = giant.join(whole, "__row").select(*docs.columns, ids)
    return ordinary.unionByName(solved.withColumn(decoded, decode(ids, path)) if decoded else solved)


def decoded_texts(words: Vocabulary, ids: pa.Array) -> pa.Array:
    views = (np.frombuffer(raw.as_buffer() if raw.is_valid else b"", dtype="<u4") for raw in ids)
    return pa.array((words.decode(view) for view in views), pa.string(), size=len(ids))


def decode(ids: Column | str, path: str | None = None) -> Column:
    """Text of an ids column."""

    @F.arrow_udf("string")
    def texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words = vocabulary(path)
        for each in batches:
            yield decoded_texts(words, each)

    return texts(ids)
