"""Marked-up conversations: what goes in comes back, and nothing in a text passes for markup."""

import random
import re

import pytest
from pyspark.sql import functions as F

from leafmill.llm import chat_format as cf

SCHEMA = "conv_id long, turn int, role string, text string, formatted string, loss_spans string"
PIECES = ["<", "|", "\\", "[", "]", "INST", "/INST]", "[INST]", "</s>", "<s>", "<<SYS>>", "<</SYS>>", "<|im_end|>\n", "<|im_start|>user\n", "<|image|>", "im_end", "|>", "\n", " ", "é", "😀", "a"]


def back(spark, rows):
    f = cf.format_conversations(spark.createDataFrame(rows, SCHEMA))
    return {r.conv_id: r for r in cf.read_back(f).collect()}, {r.conv_id: r for r in f.collect()}


def test_round_trip_of_hostile_texts(spark):
    r = random.Random(1)
    rows = [(c, t, r.choice(["user", "assistant", "system", "a\nb\\n", "<|im_end|>\n", ""]), "".join(r.choice(PIECES) for _ in range(r.randint(0, 14))), "x", "y") for c in range(150) for t in range(r.randint(1, 6))]
    got, marked = back(spark, rows)
    for c in range(150):
        own = [x for x in rows if x[0] == c]
        assert [(t.role, t.text) for t in got[c].turns] == [(x[2], x[3]) for x in own]
        assert got[c].loss_texts == [x[3] for x in own if x[2] == "assistant"]
        assert len(marked[c].formatted) == got[c].formatted_chars
        # only the template's own marks are left
        assert re.findall(r"<\|[a-z_]*\|>", marked[c].formatted) == ["<|im_start|>", "<|im_end|>"] * len(own)
        assert not re.search(r"</?s>|\[/?INST\]|<</?SYS>>", marked[c].formatted)


def test_order_nulls_repeats_and_null_conversation(spark):
    rows = [(1, 2, "user", "c", None, None), (1, None, None, None, None, None), (1, 1, "user", "b", None, None), (1, 1, "assistant", "a", None, None), (1, 1, "user", "b", None, None), (None, 1, "assistant", "z", None, None)]
    got, _ = back(spark, rows)
    assert [(t.role, t.text) for t in got[1].turns] == [("", ""), ("assistant", "a"), ("user", "b"), ("user", "b"), ("user", "c")]
    assert got[None].loss_texts == ["z"] and got[1].loss_texts == ["a"]
    assert back(spark, [])[0] == {}


def test_very_long_texts_and_many_turns(spark):
    long = "<\\|[INST]" * 100_000
    rows = [(1, 0, "assistant", long, None, None)] + [(2, i, "assistant" if i % 2 else "user", f"t{i}", None, None) for i in range(2000)]
    got, _ = back(spark, rows)
    assert got[1].loss_texts == [long]
    assert [t.text for t in got[2].turns] == [f"t{i}" for i in range(2000)] and len(got[2].loss_texts) == 1000


def test_visitor_of_parts(spark):
    part = lambda kind, text=None, ref=None, w=None, h=None, s=None, p=None: (kind, text, ref, w, h, s, p)
    rows = [
        (1, 0, "user", [part("text", "see <|image|>: "), part("image", None, "a.png", 57, 28), part("text", "!"), part("audio", None, "b.wav", s=2.1), part("document", None, "c.pdf", p=2), part("video", None, "d"), None]),
        (1, 1, "assistant", [part("text", "one"), part("image", None, "e.png", 1, 1), part("text", "<s>two"), part("image", None, None, -5, None)]),
        (1, 2, "assistant", None),
    ]
    f = cf.format_conversations(spark.createDataFrame(rows, f"conv_id long, turn int, role string, parts array<{cf.PART}>"), "parts")
    (r,), (b,) = f.collect(), cf.read_back(f).collect()
    assert r.formatted == "<|im_start|>user\nsee <\\|image|>: <|image|>!<|audio|><|document|><|other|><|other|><|im_end|>\n<|im_start|>assistant\none<|image|><\\s>two<|image|><|im_end|>\n<|im_start|>assistant\n<|im_end|>\n"
    assert [tuple(a) for a in r.attachments] == [(0, "image", "a.png", 3), (0, "audio", "b.wav", 27), (0, "document", "c.pdf", 1536), (0, "other", "d", 0), (0, "other", None, 0), (1, "image", "e.png", 1), (1, "image", None, 0)]
    assert r.n_expanded == sum(a.tokens for a in r.attachments)
    assert b.loss_texts == ["one", "<s>two"]


@pytest.mark.parametrize("content, kinds", [("plain", ["text"]), ('[{"kind":"image","ref":"x"},{"kind":"text","text":"y"}]', ["image", "text"]), ("[INST] no list", ["text"]), ("[1, 2]", ["text"]), (None, ["text"])])
def test_parts_of_json(spark, content, kinds):
    (r,) = spark.createDataFrame([(content,)], "c string").select(cf.parts_of(F.col("c")).alias("p")).collect()
    assert [p.kind for p in r.p] == kinds


def test_no_python_on_the_path(spark):
    f = cf.digests(cf.format_conversations(spark.createDataFrame([(1, 0, "user", "x", None, None)], SCHEMA)))
    assert "Python" not in f._jdf.queryExecution().toString().replace("PythonRDD", "")
