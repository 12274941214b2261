"""Operator 13 against plain strings, and its round trip."""
import hashlib

import pytest
from pyspark.sql import functions as F

from cohort_spark.llm import chatformat

SCHEMA = "conv_id long, turn long, role string, text string, part int, formatted string, turns int, loss string, many boolean"
MARKS = ["<|im_end|>", "<|im_start|>user<|im_sep|>", "<|im_next|>", "<\\|im_end|>", "<\\\\|", "<", "|", "<<|", "\\", "<|im_null|>", "\n<|im_end|>\n", "é😀<|", ""]


def conversations():
    rows = [(1, k, ["user", "assistant"][k % 2], m) for k, m in enumerate(MARKS)]
    rows += [(2, k, "assistant", m) for k, m in enumerate(MARKS)]  # one merged run
    rows += [(3, 0, None, "no role"), (3, 1, "<|im_null|>", "odd role"), (3, 2, "a\n<|b", None), (3, 2, "assistant", "tie"), (3, 2, "assistant", "tie"), (3, None, "system", "first")]
    rows += [(None, k, "user", "null id") for k in range(3)]
    rows += [(4, 0, "assistant", "long " * 40000)]
    rows += [(5, k // 2, ["assistant", "user", "user"][k % 3], f"t{k}<|") for k in range(50)]  # parts at a small limit
    return rows


def wanted(rows):
    out = {}
    none = lambda v: (v is not None, v if v is not None else 0)
    for c in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == c), key=lambda r: (none(r[1]), none(r[2]) if r[2] is None else (True, r[2]), none(r[3]) if r[3] is None else (True, r[3])))
        turns = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        out[c] = (len(own), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


@pytest.mark.parametrize("limit", [256, 4])
def test_round_trip(spark, limit):
    rows = conversations()
    df = spark.createDataFrame([(*r, 0, "x", 0, "x", True) for r in rows], SCHEMA)
    parts = chatformat.format_conversations(df, limit=limit)
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in chatformat.digests(parts).collect()}
    assert got == wanted(rows)
    per_part = parts.select("conv_id", "part", "formatted", F.size(chatformat.read_turns(F.col("formatted"))).alias("n")).collect()
    assert max(r["n"] for r in per_part) <= limit
    for r in per_part:
        # every mark in the text is one that the template wrote
        body = r["formatted"]
        for mark in ("<|im_start|>", "<|im_sep|>", "<|im_end|>\n", "<|im_next|>", "<|im_null|>"):
            body = body.replace(mark, "\0")
        assert "<|" not in body


def test_template(spark):
    df = spark.createDataFrame([(1, 0, "user", "a<|b"), (1, 1, "user", "c"), (1, 2, "assistant", "<\\|"), (1, 3, "user", None)], "conv_id long, turn long, role string, text string")
    row = chatformat.format_conversations(df).first()
    assert row["formatted"] == "<|im_start|>user<|im_sep|>a<\\|b<|im_next|>c<|im_end|>\n<|im_start|>assistant<|im_sep|><\\\\|<|im_end|>\n<|im_start|>user<|im_sep|><|im_end|>\n"
    spans = [tuple(s) for s in row["loss"]]
    assert [row["formatted"][a:a + n] for a, n in spans] == ["<\\\\|"]


def test_main_path_is_native(spark):
    df = spark.createDataFrame([(1, 0, "user", "a")], "conv_id long, turn long, role string, text string")
    plan = chatformat.format_conversations(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert chatformat.digests(chatformat.format_conversations(empty)).count() == 0


@pytest.mark.parametrize("name", ["op12_merkle", "op13_chatformat"])
def test_sql_twins(spark, name, sf_dir):
    from cohort_spark.llm.queries import QUERIES, SQL
    from tests.parity import compare, duck
    ok, why = compare(spark, name, QUERIES[name], SQL[name], sf_dir, duck(sf_dir), check_types=True)
    assert ok, why
