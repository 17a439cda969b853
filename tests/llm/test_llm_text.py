"""Token counts, packing, languages, toxicity and pieces against plain versions."""

import random
from functools import lru_cache

import numpy as np
import pytest
from tokenizers import Tokenizer

from tallyloom.llm import language, packing, piece_scan, token_counts, toxicity
from tallyloom.llm.common import vocabulary_path
from tallyloom.llm.word_tokens import VOCABULARY, word_tokens

TEXTS = [
    None, "", " \n\t ", "One, two; three.", "It's ÉCOLÉ ΣΑΣ İstanbul x y", "a<|endoftext|>b <|startoftext|> c",
    "word " * 3000, "x" * 5000, "One, two; three.", "ﬁne\tnaïve 東京 42nd — “quoted”", "é ́a  b",
]
SCHEMA = "doc_id long, text string, ids string, task int, extra string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, text, "clash", 7, None) for i, text in enumerate(TEXTS)] + [(None, "no id", None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def plain_ids():
    tokenizer = Tokenizer.from_file(vocabulary_path(VOCABULARY))
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("text", TEXTS)
def test_words_encode_as_whole_texts(text, plain_ids):
    assert np.frombuffer(next(word_tokens().ids([text])), dtype="<u4").tolist() == plain_ids(text)


def test_random_words_encode_as_whole_texts(plain_ids):
    draw = random.Random(4)
    pool = "aAbBzZ09 .,;:!?*#$%&|-_()'\"\nİIıéÉȩ\u0301\u0307ßſ\u2028\u00a0İǅẞЖж中あ𝒜ﬁ²½हिन्दी"
    texts = ["YENİ.", "İ", "aİ,", "İ!?"] + ["".join(draw.choices(pool, k=draw.randrange(1, 14))) for _ in range(20_000)]
    for text, ids in zip(texts, word_tokens().ids(texts)):
        assert np.frombuffer(ids, dtype="<u4").tolist() == plain_ids(text), text


def test_suffix_sums_answer_every_limit(spark, docs, plain_ids):
    lengths = [len(plain_ids(row.text)) for row in docs.collect()]
    sums = token_counts.suffix_sums(token_counts.length_histogram(docs)).collect()
    assert sorted(row.n_tokens for row in sums) == sorted(set(lengths))
    for row in sums:
        assert row.docs_at_least == sum(n >= row.n_tokens for n in lengths)
        assert row.tokens_at_least == sum(n for n in lengths if n >= row.n_tokens)
        assert row.truncated_tokens == sum(min(n, row.n_tokens) for n in lengths)
        assert row.docs_at_most == sum(n <= row.n_tokens for n in lengths)
    again = token_counts.suffix_sums(token_counts.length_histogram(docs))
    limits = spark.createDataFrame([(n,) for n in (0, 1, 7, 2999, 3000, 10**6)], "context int")
    for row in token_counts.truncated_totals(again, limits).collect():
        assert row.truncated_tokens == sum(min(n, row.context) for n in lengths)
    for row in token_counts.length_quantiles(again, [0.1, 0.5, 1.0]).collect():
        assert row.n_tokens == sorted(lengths)[int(np.ceil(row.q * len(lengths))) - 1]
    assert token_counts.suffix_sums(token_counts.length_histogram(docs.limit(0))).count() == 0


def test_packing_cuts_the_whole_stream_once(docs, plain_ids):
    pieces = packing.pack(docs.repartition(3), window=64).toPandas()
    stream = pieces.sort_values(["sequence_id", "offset"])
    assert (stream.sequence_id * 64 + stream.offset).tolist() == (stream.length.cumsum() - stream.length).tolist()
    for row in docs.collect():
        own = pieces[pieces.doc_id.isna() if row.doc_id is None else pieces.doc_id == row.doc_id].sort_values("start")
        ids = plain_ids(row.text) + [1]
        assert np.frombuffer(b"".join(own.ids), dtype="<u4").tolist() == ids
        assert own.start.tolist() == (own.length.cumsum() - own.length).tolist()
        assert set(own.doc_tokens) == {len(ids)}
        assert own.goes_back.tolist() == (own.start > 0).tolist()
        assert own.goes_on.tolist() == (own.start + own.length < len(ids)).tolist()
    assert packing.pack(docs.limit(0)).count() == 0


def test_forward_sums_all_segmentations():
    table, pieces = language.piece_table(), language.pieces_of()
    rng = np.random.default_rng(0)
    chance = np.vstack([rng.random((len(pieces) + 1, 2)) / 100, np.zeros((1, 2))])

    @lru_cache(maxsize=None)
    def total(word, column):
        if not word:
            return 1.0
        out = 0.0
        for k in range(1, len(word) + 1):
            number = pieces.get(word[:k], len(pieces) if k == 1 else None)
            out += chance[number, column] * total(word[k:], column) if number is not None else 0
        return out

    assert table.longest == max(map(len, pieces)) > 8
    longest = max(pieces, key=len).removeprefix(language.START)
    words = ["theirs", "größer", "ñandú1"[:5], "日本語日本", "हिन्दी", longest, f"{longest}and{longest}s"]
    words += ["internationalisation", "einundzwanzigtausendsechshundertdreiunddreißig"]
    for part in language.by_length(words):
        lattice = language.Lattice([words[i] for i in part], table)
        found = lattice.log_likelihood(chance)
        for row, i in zip(found, part):
            assert np.allclose(row, [np.log(total(language.START + words[i], c)) for c in (0, 1)])
        uses = lattice.expected(chance[:, [0]], np.ones(len(part)))
        assert uses.sum() > 0 and uses[-1] == 0
        # Every segmentation covers every character once.
        widths = np.ones(len(pieces) + 2)
        widths[list(pieces.values())] = [len(piece) for piece in pieces]
        assert np.isclose(uses @ widths, sum(len(words[i]) + 1 for i in part))


def test_long_runs_are_scored_whole():
    table, pieces = language.piece_table(), language.pieces_of()
    chance = np.full((len(pieces) + 2, 2), 1e-6)
    chance[-1] = 0
    a, b = (language.Lattice([word], table).log_likelihood(chance)[0] for word in ("haus" * 20_000, "haus" * 40_000))
    assert np.isfinite(b).all() and (b < a).all() and np.allclose(b / a, 2, rtol=1e-3)
    assert language.words_of("हिन्दी में " + "x" * 99) == ["हिन्दी", "में", "x" * 99] and language.words_of("12 \u0301") == []


def test_languages_are_told_apart(spark):
    rows = [(i, "the house and the garden with water", "en") for i in range(20)]
    rows += [(i + 20, "das haus und der garten mit wasser", "de") for i in range(20)]
    model = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    asked = [(1, "the water and the house"), (2, "der garten und das wasser"), (3, None), (4, "12 — !"), (5, ""), (6, "the " * 9999)]
    asked = spark.createDataFrame([(*row, "clash") for row in asked], "doc_id long, text string, score string")
    found = {r.doc_id: r for r in language.identify(asked, model, score="sure").collect()}
    assert [found[i].lang_pred for i in range(1, 7)] == ["en", "de", "und", "und", "und", "en"]
    assert all(0 <= r.sure <= 1 for r in found.values()) and found[1].score == "clash"
    nothing = language.train(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert {r.lang_pred for r in language.identify(asked.drop("score"), nothing).collect()} == {"und"}


def test_toxic_texts_score_higher(spark):
    rng = np.random.default_rng(1)
    plain = ["".join(rng.choice(list("abcdefghilmnorstu"), 5)) for _ in range(400)]
    words = lambda bad: " grubfang ".join(" ".join(rng.choice(plain, 20)) for _ in range(bad + 1))
    rows = [(i, words(3 * (i % 4 == 0)), int(i % 4 == 0)) for i in range(400)]
    data = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train(data.select("doc_id", "text").where("doc_id < 300"), data.where("doc_id < 300"))
    scored = data.withColumn("p", toxicity.score(model, "text")).where("doc_id >= 300").toPandas()
    assert ((scored.p >= toxicity.THRESHOLD) == (scored.toxic == 1)).mean() > 0.9
    odd = spark.createDataFrame([(None,), ("",), (" ",), ("grubfang " * 50000,), ("y" * 100000,)], "text string")
    found = [r.p for r in odd.select(toxicity.score(model, "text").alias("p")).collect()]
    assert found[0] == found[1] == found[2] < toxicity.THRESHOLD < found[3] and all(0 <= p <= 1 for p in found)
    assert toxicity.train(data.limit(0), data.limit(0)).scores(["a", None]).tolist() == [0, 0]


def test_without_evidence_the_score_is_the_share_of_toxic_labels(spark):
    rows = [(k, f"all the same words {k}", int(k % 10 == 0)) for k in range(200)]
    data = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    assert toxicity.train(data, data).scores(["all the same words", None, ""]) == pytest.approx([0.1] * 3)
    only = data.where("toxic = 1")
    assert toxicity.train(only, only).scores(["a"]).tolist() == [1.0]


def test_training_sample_reaches_texts_without_moving_them(spark):
    data = spark.createDataFrame([(k, f"text {k}", k % 2) for k in range(50)], "doc_id long, text string, toxic int")
    chosen = toxicity.training_rows(data.select("doc_id", "text"), data, "text", "doc_id", "toxic", 1500)
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert chosen.count() == 50


def test_scores_are_those_of_windows_compressed_one_by_one(spark):
    zstandard = pytest.importorskip("zstandard")
    toxic = [f"some plain words {k} idiots and scumbags {k * 7}" for k in range(60)]
    model = toxicity.fit(toxic, [f"some plain words {k} kind people {k * 5}" for k in range(60)])
    ordinary, both = model.compressors()
    for text in ["idiots", "some plain words", "x " * 100 + "scumbags and idiots " * 9, None]:
        gains = [abs(len(ordinary.compress(w)) - len(both.compress(w))) for w in toxicity.windows(text)] or [0]
        found = model.features([text])[0]
        assert found[: len(toxicity.GAINS)] == pytest.approx([np.log1p(sum(g >= least for g in gains)) for least in toxicity.GAINS])
        assert found[len(toxicity.GAINS)] == max(gains) / 4
    assert isinstance(ordinary, zstandard.ZstdCompressor)


def plain_viterbi(words, text):
    best = [(0, ())] + [(piece_scan.LOW, ())] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - words.longest), end):
            piece = words.pieces.get(text[start:end])
            gain = piece[0] if piece else words.lost if start == end - 1 else None
            if gain is not None and best[start][0] + gain > best[end][0]:
                ids = (piece[1],) if piece else tuple(words.spelled(text[start]))
                best[end] = best[start][0] + gain, (*best[start][1], *ids)
    return best[-1]


@pytest.mark.parametrize("text", ["hello, world.", "  two  spaces ", "tab\there\n", "日本語 😀 é", "aaaaaaaaaaaaaaaaaaaaaaaaaaa", "1.5%"])
def test_pieces_are_the_best_segmentation(text):
    words = piece_scan.vocabulary()
    score, ids = plain_viterbi(words, piece_scan.marked(text))
    found = words.encode(piece_scan.marked(text))
    assert tuple(np.frombuffer(found, dtype="<u4")) == ids
    assert words.score(piece_scan.marked(text)) == score
    assert words.decode(np.array(ids)) == text


@pytest.mark.parametrize("text", ["some words, and more of them. " * 12, "z" * 300, " " * 200, "ab😀 " * 60])
@pytest.mark.parametrize("size", [64, 97])
def test_chunks_give_the_same_score(text, size):
    words, whole = piece_scan.vocabulary(), piece_scan.marked(text)
    parts = [(whole[k : k + size + words.longest - 1], min(size, len(whole) - k)) for k in range(0, len(whole), size)]
    matrices = [words.transfer(*part) for part in parts]
    together = matrices[0]
    for each in matrices[1:]:
        together = piece_scan.combine(together, each)
    assert together[0, 0] == words.best(whole, 0, len(whole))[0][-1]
    states = piece_scan.boundary_states(matrices)
    ids = b"".join(words.between(*part, a, b) for part, a, b in zip(parts, states, states[1:]))
    assert words.decode(np.frombuffer(ids, dtype="<u4")) == text


def test_giant_texts_round_trip(docs):
    found = piece_scan.encode(docs.drop("ids"), size=256).withColumn("back", piece_scan.decode("ids")).collect()
    assert len(found) == len(TEXTS) + 1
    for row in found:
        assert row.back == (row.text or "") and row.task in (7, None)
