"""Text functions on input that the shared tables lack."""

import random
import string

import pytest
from pyspark.sql import functions as F

from tallyloom.constants import LINE_ENDS, PUNCTUATION, WHITESPACE
from tallyloom.functions import chat, text, tokens

SPACES = [chr(code) for code in range(0x3001) if chr(code).isspace()]


def apply(spark, values, *columns):
    """Results of the columns over one text column ``t``, in the order of the values."""
    rows = spark.createDataFrame(list(enumerate(values)), "id int, t string")
    out = rows.select("id", *[column.alias(f"c{at}") for at, column in enumerate(columns)]).orderBy("id").collect()
    return [tuple(row)[1:] if len(columns) > 1 else row[1] for row in out]


def test_character_sets():
    assert sorted(WHITESPACE) == sorted(SPACES)
    assert PUNCTUATION == string.punctuation
    assert sorted(LINE_ENDS) == [c for c in map(chr, range(0x3001)) if len(f"a{c}b".splitlines()) == 2]


def test_informative_and_clean(spark):
    values = [None, "", "  ", "nan", " NaN ", "None", "NULL", "undefined", "n/a", "N/A\t", "unknown", "\x85unknown　"]
    values += ["nano", "leaf  spot", " leaf\xa0\x1f\nspot\x1c", "0", "na"]
    out = apply(spark, values, text.informative("t"), text.clean("t"))
    for value, (good, cleaned) in zip(values, out):
        words = ("", "nan", "none", "null", "undefined", "n/a", "unknown")
        expected = value is not None and value.strip().lower() not in words
        assert good is expected, value
        assert cleaned == (" ".join(value.split()) if expected else "")


def test_informative_numbers(spark):
    rows = spark.createDataFrame([(1.5,), (float("nan"),), (None,)], "x double")
    assert [row[0] for row in rows.select(text.informative("x")).collect()] == [True, False, False]


@pytest.mark.parametrize("space", SPACES)
def test_every_white_space(spark, space):
    value = f"{space}A{space}{space}B{space}"
    out = apply(
        spark, [value], text.strip("t"), text.collapse_space("t"), text.normalize_label("t"), text.first_line("t")
    )[0]
    assert out[:3] == (value.strip(), "A B", "a b")
    assert out[3] == [line.strip() for line in value.splitlines() if line.strip()][0]


def test_class_name(spark):
    assert apply(spark, [None, "", "　 Rust "], text.class_name("t")) == ["Unknown", "", "Rust"]


def test_target_rules_differ(spark):
    rows = spark.createDataFrame(
        [("Rust", "r"), ("Unknown", "raw  x"), ("", "raw"), (None, None), ("nan", "n/a"), ("", None)],
        "target string, raw string",
    )
    out = rows.select(
        text.training_target("target", "raw"), text.scoring_truth("target", "raw"), text.training_target("target")
    ).collect()
    assert [tuple(row) for row in out] == [
        ("Rust", "Rust", "Rust"),
        ("raw x", "Unknown", "Unknown Disease"),
        ("raw", "raw", "Unknown Disease"),
        ("", "Unknown", "Unknown Disease"),
        ("", "nan", "Unknown Disease"),
        ("", "Unknown", "Unknown Disease"),
    ]


def test_answer_keeps_the_class_line_and_refuses_provenance(spark):
    row = spark.createDataFrame([(None, "x")], "target string, quote string")
    assert row.select(text.answer_text("target", "target")).first()[0] == "Diagnosis: "
    with pytest.raises(ValueError):
        text.answer_text("target", context={"symptom_quote": "quote"})


def test_normalize_label(spark):
    cases = {
        None: "",
        "": "",
        "  'Leaf-Spot'. ": "leaf spot",
        "leaf_ -\tspot": "leaf spot",
        "(St. John's rust)": "st. john's rust",
        "---": "",
        "- rust -": "rust",
        " Rust ": "rust",
        "...a.b...": "a.b",
    }
    assert apply(spark, list(cases), text.normalize_label("t")) == list(cases.values())


def test_normalize_label_settles(spark):
    """Twice is not always once: removing punctuation can bare a space and more punctuation."""
    values = ["a", "Leaf-Spot", '"x"', "\t.a", "a .", "_-_"]
    once = apply(spark, values, text.normalize_label("t"))
    twice = apply(spark, once, text.normalize_label("t"))
    assert once == twice


def test_extraction_quirks(spark):
    cases = {
        "Diagnosis:\nCrop: Tomato": ("Crop: Tomato", "Tomato", "", ""),
        "Diagnosis:   ": ("", "", "", ""),
        "Diagnosis: Rust ; \r\nPlant: Rice.,;": ("Rust ", "Rice", "", ""),
        "Genotype: X1\nCounterpart: y": ("X1", "", "X1", "y"),
        "Answer: Rust: bad": ("Rust: bad", "", "", ""),
        "DISEASE   type : Fungal.": ("Fungal.", "", "Fungal", ""),
        "": ("", "", "", ""),
        "\n  Just text": ("Just text", "", "", ""),
        "Diagnosis: a\x0bb": ("a\x0bb", "", "", ""),
        "Diagnosiſ: odd s": ("odd s", "", "", ""),
        "host crop:　Maize　": ("Maize", "Maize", "", ""),
    }
    parsed = text.parse_answer("t")
    out = apply(spark, list(cases), parsed["diagnosis"], parsed["crop"], parsed["disease_type"], parsed["plant_organ"])
    assert out == list(cases.values())


def test_parse_of_null_is_empty(spark):
    row = spark.createDataFrame([(None,)], "t string").select(text.parse_answer("t").alias("p")).first()[0]
    assert set(row.asDict().values()) == {""}


def test_first_line_like_splitlines(spark):
    draw = random.Random(7)
    values = ["".join(draw.choice("ab: \t\n\r\x0b\x0c\x1c\x85 .") for _ in range(draw.randint(0, 12))) for _ in range(400)]
    for value, (line, rest) in zip(values, apply(spark, values, text.first_line("t"), text.fallback_class("t"))):
        lines = [part.strip() for part in value.splitlines() if part.strip()]
        expected = lines[0] if lines else ""
        assert line == expected
        assert rest == (expected.split(":", 1)[1].strip() if ":" in expected else expected)


def test_matches(spark):
    rows = spark.createDataFrame([(" Rust", "rust "), ("", ""), ("Rust.", "rust"), ("a", None)], "g string, p string")
    out = rows.select(text.exact_match("g", "p"), text.is_correct("g", "p"), text.is_correct("g", "p", False)).collect()
    assert [tuple(row) for row in out] == [
        (True, True, True),
        (True, False, True),
        (False, True, True),
        (False, False, False),
    ]


def test_formatters(spark):
    assert apply(spark, ["1234567", "12.5", "n", None], text.thousands("t")) == ["1,234,567", "12.5", "n", "N/A"]
    seconds = spark.createDataFrame([(59.9,), (3599.0,), (3600.0,), (36061.0,), (0.0,)], "s double")
    shown = [row[0] for row in seconds.select(text.duration("s")).collect()]
    assert shown == ["00m 59s", "59m 59s", "1h 00m", "10h 01m", "00m 00s"]


def masked(ids, mask, marker, prompt):
    start = next((at for at in range(len(ids) - len(marker) + 1) if ids[at : at + len(marker)] == marker), None)
    cut = min(prompt, len(ids)) if start is None else start + len(marker)
    return [-100 if at < cut or not seen else token for at, (token, seen) in enumerate(zip(ids, mask))]


def test_loss_labels(spark):
    draw = random.Random(3)
    cases = [([], []), ([7], [1]), ([12, 3], [1, 1]), ([1, 23], [1, 1]), ([2, 3, 2, 3], [0, 1, 1, 1])]
    for _ in range(300):
        ids = [draw.choice([1, 2, 3, 23, 12]) for _ in range(draw.randint(0, 9))]
        cases.append((ids, [draw.choice([0, 1, 1]) for _ in ids]))
    rows = spark.createDataFrame([(at, *case) for at, case in enumerate(cases)], "id int, ids array<int>, mask array<int>")
    for marker in ([2, 3], [3], [1, 2, 3]):
        out = rows.orderBy("id").select(tokens.loss_labels("ids", "mask", marker, F.lit(4))).collect()
        assert [row[0] for row in out] == [masked(*case, marker, 4) for case in cases]


def test_drop_prompt(spark):
    rows = spark.createDataFrame([([1, 2, 3], [9]), ([1], [9, 9]), ([], [])], "o array<int>, i array<int>")
    assert [row[0] for row in rows.select(tokens.drop_prompt("o", "i")).collect()] == [[2, 3], [], []]


def test_conversation_shape(spark):
    row = spark.createDataFrame([("p", "q", "a")], "img string, q string, a string")
    with_answer, bare = row.select(chat.conversation("img", "q", "a"), chat.conversation("img", "q")).first()
    assert [message.role for message in with_answer] == ["user", "assistant"]
    assert [(part.type, part.text, part.image) for part in with_answer[0].content] == [
        ("image", None, "p"),
        ("text", "q", None),
    ]
    assert with_answer[1].content[0].text == "a"
    assert len(bare) == 1


def test_long_conversations_stay_one_row(spark):
    from tallyloom.operators.conversations import render_turns

    turns = spark.range(2500).selectExpr("1 AS conv_id", "2499 - id AS turn", "'user' AS role", "concat('t', 2499 - id) AS text")
    found = render_turns(turns.repartition(7), add_generation_prompt=True).collect()
    assert len(found) == 1
    lines = [f"<|im_start|>user\nt{i}<|im_end|>\n" for i in range(2500)]
    assert found[0].rendered == "".join(lines) + "<|im_start|>assistant\n"
