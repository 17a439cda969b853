"""Language by segmentation-marginalised unigrams.

Each language is a unigram model over the pieces of a fixed public vocabulary. The probability of a word is the
sum over *all* its segmentations into pieces, found by a forward pass; a text's is the product over its words, since
no piece crosses a word. Words are whole runs of letters with their marks, pieces have any length; values are rescaled on the
way, so long runs do not underflow. Characters that no piece covers stand for themselves at a floor probability.

**Training.** Words of labelled documents are counted per language in Spark. Expectation-maximisation runs over these
counts: every task passes forward and backward through its words and gives expected piece counts, Spark
adds them, and only the pieces' probabilities (at most vocabulary x languages numbers) come to the driver.
Training reads about ``TRAIN_DOCS`` documents per language, chosen by the hash of their id.

**Prediction.** The language with the largest posterior, where priors are equal and evidence is tempered:
``score`` is the posterior with log-likelihoods divided by the square root of the number of words, since words
of a text do not come independently. Texts that are null or have no letter are ``und`` with score 0. If
there are no labels, every text is ``und``. Ties go to the first language by name. Scoring reads whole texts; each
task keeps a bounded table of word -> log-probabilities.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import vocabulary_path

VOCABULARY = "piece_bpe_32k.model"
TRAIN_DOCS, ROUNDS = 400, 4
#: Longer runs of letters are scored whole, but not learned from.
TRAIN_WORD = 4096
#: Positions after which forward and backward values are brought back to about 1, and positions looked up at once.
RESCALE, BLOCK = 16, 1 << 16
FLOOR, SMOOTHING = 1e-7, 0.1
WORDS_KEPT, CHARACTERS_KEPT = 1_000_000, 32_000_000
UNDETERMINED = "und"
START = "▁"
# Marks (vowel signs, accents) belong to the word of the letter before them.
MARKS = re.escape("".join(c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c)[0] == "M"))
# No mark lies before U+0300: most word ends are told by that alone.
WORDS = re.compile(rf"[^\W\d_]++(?:(?=[\u0300-\U0010FFFF])[{MARKS}]++[^\W\d_]*+)*+")
PIECE = re.compile(rf"(?:[^\W\d_]|[{MARKS}])+")


@lru_cache(maxsize=2)
def pieces_of(path: str | None = None) -> dict[str, int]:
    """Piece -> number, lower case, letters and their marks only, of any length; START marks the beginning of a word."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path or vocabulary_path(VOCABULARY))
    names = {model.id_to_piece(i).lower() for i in range(model.vocab_size()) if not model.is_control(i)}
    names = {n for n in names if PIECE.fullmatch(n.removeprefix(START)) or n == START}
    return {name: number for number, name in enumerate(sorted(names))}


def words_of(text: str | None) -> list[str]:
    """Lower-case runs of letters with their marks, of any length; none for a text without a letter."""
    words = WORDS.findall((text or "").lower())
    return words if any(c.isalpha() for word in words for c in word) else []


class PieceTable:
    """Finds pieces by a rolling hash of code points, for all substrings of many words at once."""

    SLOTS = 20
    BASE, SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)

    def __init__(self, pieces: dict[str, int]):
        self.size, self.longest = len(pieces), max(map(len, pieces))
        self.hashes = np.zeros(self.size, dtype=np.uint64)
        for width in range(1, self.longest + 1):
            some = [piece for piece in pieces if len(piece) == width]
            if some:
                codes = np.array(some).view(np.uint32).reshape(len(some), -1)
                self.hashes[[pieces[piece] for piece in some]] = self.rolled(codes, width)[-1][:, 0]
        self.chains: list[np.ndarray] = []
        left = np.arange(self.size)
        while len(left):
            chain = np.full(1 << self.SLOTS, -1, dtype=np.int32)
            chain[self.slot(self.hashes[left])] = left
            self.chains.append(chain)
            left = left[chain[self.slot(self.hashes[left])] != left]

    def slot(self, hashes: np.ndarray) -> np.ndarray:
        return ((hashes * self.SPREAD) >> np.uint64(64 - self.SLOTS)).astype(np.int64)

    def rolled(self, codes: np.ndarray, longest: int) -> list[np.ndarray]:
        """For each width 1, 2, ... the hashes of all substrings of that width, by start."""
        codes = codes.astype(np.uint64) + np.uint64(1)
        out = [codes * self.BASE]
        for width in range(2, min(longest, codes.shape[1]) + 1):
            out.append((out[-1][:, :-1] + codes[:, width - 1 :]) * self.BASE)
        return out

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Piece numbers, ``size + 1`` for no piece."""
        out, slots = np.full(hashes.shape, self.size + 1, dtype=np.int32), self.slot(hashes)
        for chain in self.chains:
            found = chain[slots]
            hit = (found >= 0) & (self.hashes[found] == hashes)
            out[hit] = found[hit]
        return out

    def found(self, codes: np.ndarray) -> list[np.ndarray]:
        """For each width the pieces by start; a character without a piece is ``size``."""
        found = [self.find(hashes) for hashes in self.rolled(codes, self.longest)]
        found[0] = np.minimum(found[0], self.size)
        return found


@lru_cache(maxsize=2)
def piece_table(path: str | None = None) -> PieceTable:
    return PieceTable(pieces_of(path))


class Lattice:
    """Pieces in words of one length. Probabilities come as (pieces + 2) x languages: the last
    two rows are a character that no piece covers, and no piece at all (0)."""

    def __init__(self, words: list[str], table: PieceTable):
        marked = np.array([START + word for word in words])
        self.codes, self.table = marked.view(np.uint32).reshape(len(words), -1), table
        self.rows, self.length = self.codes.shape

    def log_likelihood(self, probability: np.ndarray) -> np.ndarray:
        """By row and language; keeps as many positions as the longest piece has, however long the words are."""
        longest = self.table.longest
        ring = np.zeros((longest, self.rows, probability.shape[1]))
        ring[0] = 1
        scale = np.zeros(ring.shape[1:])
        for begin in range(0, self.length, BLOCK):
            low = max(0, begin - longest)
            found = self.table.found(self.codes[:, low : begin + BLOCK])
            for end in range(begin + 1, min(self.length, begin + BLOCK) + 1):
                total = np.zeros_like(scale)
                for width in range(1, min(end, len(found)) + 1):
                    start = end - width
                    pieces = found[width - 1][:, start - low]
                    rows = np.flatnonzero(pieces <= self.table.size)
                    if 2 * len(rows) > self.rows:
                        total += ring[start % longest] * probability[pieces]
                    elif len(rows):  # long pieces lie in few words
                        total[rows] += ring[start % longest][rows] * probability[pieces[rows]]
                if end % RESCALE == 0:
                    ring /= total
                    scale += np.log(total)
                    total = np.ones_like(scale)
                ring[end % longest] = total
        return scale + np.log(ring[self.length % longest])

    def expected(self, probability: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected uses of each piece for word counts of one language (``probability``: one column)."""
        longest, chance, found = self.table.longest, probability[:, 0], self.table.found(self.codes)

        def steps(end: int):
            for width in range(1, min(end, len(found)) + 1):
                pieces = found[width - 1][:, end - width]
                rows = np.flatnonzero(pieces <= self.table.size)
                if len(rows):
                    yield end - width, rows, pieces[rows]

        # Values are held relative to exp(scale), which each position has its own of.
        alpha, beta = np.zeros((self.length + 1, self.rows)), np.zeros((self.length + 1, self.rows))
        before, after = np.zeros_like(alpha), np.zeros_like(beta)
        alpha[0], beta[-1], scale = 1, 1, np.zeros(self.rows)
        for end in range(1, self.length + 1):
            for start, rows, pieces in steps(end):
                alpha[end, rows] += alpha[start, rows] * chance[pieces]
            if end % RESCALE == 0:
                scale, factor = scale + np.log(alpha[end]), alpha[end].copy()
                alpha[max(0, end - longest) : end + 1] /= factor
                before[max(0, end - longest) : end + 1] = scale
            before[end] = scale
        whole, scale, uses = np.log(alpha[-1]) + scale, np.zeros(self.rows), np.zeros(len(chance))
        for end in range(self.length, 0, -1):
            if end % RESCALE == 0:
                scale, factor = scale + np.log(beta[end]), beta[end].copy()
                beta[max(0, end - longest) : end + 1] /= factor
            after[end] = scale
            for start, rows, pieces in steps(end):
                through = chance[pieces] * beta[end, rows]
                beta[start, rows] += through
                share = counts[rows] * np.exp(before[start, rows] + after[end, rows] - whole[rows])
                uses += np.bincount(pieces, weights=alpha[start, rows] * through * share, minlength=len(uses))
        return uses


def by_length(words: list[str], at_once: int = 4096, characters: int = 1 << 17) -> Iterator[np.ndarray]:
    """Positions of words of one length, in parts of bounded rows and characters."""
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    order = np.argsort(lengths, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
        step = max(1, min(at_once, characters // max(1, int(lengths[part[0]])))) if len(part) else 1
        for start in range(0, len(part), step):
            yield part[start : start + step]


def word_counts(
    docs: DataFrame, text: str, lang: str, key: str, bound: int = TRAIN_DOCS
) -> DataFrame:
    """``lang, word, n`` over about ``bound`` labelled documents of each language."""
    labelled = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & (F.col(lang) != UNDETERMINED))
    sizes = labelled.groupBy(F.col(lang).alias("lang")).agg(F.count("*").alias("docs"))
    draw = F.pmod(F.xxhash64(F.col(key), F.lit(3)), F.lit(1 << 30)) / float(1 << 30)
    # One row per language.
    chosen = labelled.join(F.broadcast(sizes), F.col(lang) == F.col("lang")) if lang != "lang" else labelled.join(
        F.broadcast(sizes), "lang"
    )
    chosen = chosen.where(draw < F.lit(float(bound)) / F.col("docs")).select(F.col(lang).alias("lang"), F.col(text).alias("text"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for name, texts in rows.groupby("lang")["text"]:
                held: Counter = Counter()
                for each in texts:
                    held.update(word for word in words_of(each) if len(word) <= TRAIN_WORD)
                if held:
                    yield pd.DataFrame({"lang": name, "word": list(held), "n": list(held.values())})

    counts = chosen.mapInPandas(count, "lang string, word string, n long")
    return counts.groupBy("lang", "word").agg(F.sum("n").alias("n"))


class Model:
    """Piece probabilities per language."""

    def __init__(self, languages: list[str], probability: np.ndarray, path: str | None):
        self.languages, self.probability, self.path = languages, probability, path

    def word_scores(self, words: list[str]) -> np.ndarray:
        table, out = piece_table(self.path), np.zeros((len(words), len(self.languages)), dtype=np.float32)
        for part in by_length(words):
            out[part] = Lattice([words[i] for i in part], table).log_likelihood(self.probability)
        return out

    def predict(self, texts: list, known: KnownWords) -> list[tuple[str, float]]:
        if not self.languages:
            return [(UNDETERMINED, 0.0)] * len(texts)
        counted = [Counter(words_of(text)) for text in texts]
        known.learn(counted, self.word_scores)
        out = []
        for words in counted:
            if not words:
                out.append((UNDETERMINED, 0.0))
                continue
            n = np.fromiter(words.values(), dtype=np.float64, count=len(words))
            rows = np.fromiter(map(known.place.__getitem__, words), dtype=np.int64, count=len(words))
            total = n @ known.scores[rows] / np.sqrt(n.sum())
            best = int(total.argmax())
            out.append((self.languages[best], float(1 / np.exp(total - total[best]).sum())))
        return out


class KnownWords:
    """Word -> row of log-probabilities; starts anew when it is full, so memory is bounded."""

    def __init__(self, limit: int = WORDS_KEPT):
        self.limit, self.place, self.scores, self.characters = limit, {}, None, 0

    def learn(self, counted: list[Counter], compute) -> None:
        missing = {word for words in counted for word in words if word not in self.place}
        if len(self.place) + len(missing) > self.limit or self.characters > CHARACTERS_KEPT:
            self.place, self.scores, self.characters = {}, None, 0
            missing = {word for words in counted for word in words}
        if not missing:
            return
        words = list(missing)
        self.characters += sum(map(len, words))
        fresh, used = compute(words), len(self.place)
        if self.scores is None or used + len(words) > len(self.scores):
            room = np.zeros((max(used + len(words), min(self.limit, 2 * used)), fresh.shape[1]), dtype=np.float32)
            if used:
                room[:used] = self.scores[:used]
            self.scores = room
        self.scores[used : used + len(words)] = fresh
        self.place.update(zip(words, range(used, used + len(words))))


def train(
    docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", bound: int = TRAIN_DOCS,
    rounds: int = ROUNDS, path: str | None = None,
) -> Model:
    """Fit by expectation-maximisation; ``docs`` should hold training rows only."""
    from tallyloom.sources.workspace import stage

    counts = stage(word_counts(docs, text, lang, key, bound), "language")
    languages = [row[0] for row in counts.select("lang").distinct().orderBy("lang").collect()]
    size = len(pieces_of(path)) + 2
    probability = np.full((size, max(1, len(languages))), 1.0 / size)
    probability[-1] = 0
    for _ in range(rounds if languages else 0):
        known, place = probability, {name: i for i, name in enumerate(languages)}

        def uses(batches: Iterator[pd.DataFrame], known=known, place=place) -> Iterator[pd.DataFrame]:
            table, total = piece_table(path), np.zeros_like(known)
            for rows in batches:
                for name, part in rows.groupby("lang"):
                    column = place[name]
                    words, n = part.word.tolist(), part.n.to_numpy(dtype=float)
                    for some in by_length(words):
                        lattice = Lattice([words[i] for i in some], table)
                        total[:, column] += lattice.expected(known[:, [column]], n[some])
            piece, column = np.nonzero(total)
            yield pd.DataFrame({"piece": piece, "language": column, "uses": total[piece, column]})

        found = counts.mapInPandas(uses, "piece long, language long, uses double")
        found = found.groupBy("piece", "language").agg(F.sum("uses").alias("uses")).toPandas()
        added = np.zeros_like(probability)
        added[found.piece.to_numpy(), found.language.to_numpy()] = found.uses.to_numpy()
        probability = (added + SMOOTHING) / (added + SMOOTHING).sum(axis=0)
        probability[-2:] = [[FLOOR], [0]]
    return Model(languages, probability, path)


def identify(
    docs: DataFrame, model: Model, text: str = "text", lang: str = "lang_pred", score: str = "score"
) -> DataFrame:
    """``docs`` with the predicted language and its score."""

    @F.pandas_udf(f"`{lang}` string, `{score}` double")
    def predictions(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = KnownWords()
        for texts in batches:
            found = [
                pair for i in range(0, len(texts), 512) for pair in model.predict(texts[i : i + 512].tolist(), known)
            ]
            yield pd.DataFrame(found, columns=[lang, score]).astype({lang: object, score: float})

    held = "__llm_language"
    return docs.withColumn(held, predictions(text)).select(*docs.columns, f"{held}.{lang}", f"{held}.{score}")
