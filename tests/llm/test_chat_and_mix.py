"""Chat formatting and mixing."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from censusmart.llm import chat, mixing, running

PIECES = ["</s>", "<s>", "[INST]", "[/INST]", "[ANSWER]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[SAYS]", "[/ROLE]", "\\", "<", "[", " ", "/s>", "\n", "ä", "$0", "x"]


def read_back(spark, rows):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.format_conversations(frame).withColumn("text", chat.formatted_text(F.col("segments")))
    return {r.conv_id: r for r in out.select("conv_id", "n_turns", "valid", "text", chat.parsed_turns(F.col("text")).alias("turns"),
                                             chat.loss_text(F.col("segments")).alias("loss")).collect()}


def test_round_trip_of_hostile_texts(spark):
    rows, drawn = [], []

    @settings(max_examples=300, deadline=None, database=None)
    @given(st.lists(st.sampled_from(PIECES), max_size=8))
    def draw(parts):
        drawn.append("".join(parts))
    draw()
    roles = ["user", "assistant", "system", "tool</s>", ""]
    for i, text in enumerate(drawn):
        rows += [(i, t, roles[(i + t) % 5], text if t != 1 else text[::-1]) for t in range(3)]
    got = read_back(spark, rows)
    for i in range(len(drawn)):
        own = [r for r in rows if r[0] == i]
        assert [(t.role, t.text) for t in got[i].turns] == [(r[2], r[3]) for r in own]
        assert got[i].loss == "".join(r[3] for r in own if r[2] == "assistant") and got[i].n_turns == 3


def test_order_nulls_and_ties(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (2, 0, "assistant", "x"), (3, None, "user", "z"), (3, 0, None, None),
            (None, 0, "user", "n"), (4, 0, "system", "s"), (4, 1, "user", "u"), (5, 0, "user", "q"), (5, 0, "user", "p")]
    got = read_back(spark, rows)
    assert {k: v.valid for k, v in got.items()} == {1: True, 2: False, 3: False, None: True, 4: True, 5: False}
    assert [(t.role, t.text) for t in got[3].turns] == [("", ""), ("user", "z")] and [t.text for t in got[5].turns] == ["p", "q"]
    assert chat.format_conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_overlapping_control_strings_are_refused():
    with pytest.raises(ValueError):
        chat.Template(begin="[INST]]").controls()


def fair(sizes, weights):
    """Water-filling by rounds."""
    total, targets, free = sum(sizes), {}, set(range(len(sizes)))
    while free:
        level = (total - sum(targets.values())) / sum(weights[i] for i in free)
        over = {i for i in free if weights[i] * level >= 3 * sizes[i]}
        targets |= {i: 3 * sizes[i] for i in over} if over else {i: weights[i] * level for i in free}
        free = free - over if over else set()
    return targets


def test_mix(spark):
    docs = [(i, " ".join("w" for _ in range(1 + i * 7 % 40)), None if i % 9 == 0 else f"s{i % 9 if i % 3 else 1}", 0) for i in range(900)]
    docs += [(1000, None, "s1", 0), (1001, "", "empty", 0), (None, "a b", "s2", 0), (5, docs[5][1], docs[5][2], 0)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string, size int")
    plan = mixing.mixing_plan(frame).collect()
    names = sorted({d[2] for d in docs if d[2]}) + [None]
    sizes = [sum(len((d[1] or "").split()) for d in docs if d[2] == s) for s in names]
    targets = fair(sizes, [1 + i % 3 for i in range(len(names))])
    for i, s in enumerate(names):
        own = [r for r in plan if r.source == s]
        assert all(r.source_size == sizes[i] and abs(r.target - targets[i]) < 1e-6 and 0 <= r.passes <= 3 for r in own)
        assert abs(sum(r.passes * r.size * r.rows for r in own) - targets[i]) <= 85
    assert sum(r.passes * r.size * r.rows for r in plan) <= sum(sizes)
    mixed = mixing.mix_documents(frame)
    assert mixed.columns == frame.columns and mixed.count() == sum(r.passes * r.rows for r in plan)
    assert mixing.mix_documents(frame.limit(0)).count() == 0


def test_ranges_of_the_queue_are_bounded_in_rows(spark, monkeypatch):
    """A giant document, a source of empty texts and null ids spread over the ranges; their number changes no result."""
    docs = [(0, "w " * 50_000, "giant")] + [(i, "w", "giant") for i in range(1, 1500)] + [(i, "", "empty") for i in range(1500, 3000)]
    docs += [(None, f"a {i}", "nulls") for i in range(1500)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(8)
    seen, whole = [], running.ranged

    def watched(*args):
        got = whole(*args)
        seen.append([r["count"] for r in got.groupBy("_range").count().collect()])
        return got

    monkeypatch.setattr(mixing, "ranged", watched)
    one = sorted(map(str, mixing.mixing_plan(frame).collect()))
    assert [len(counts) for counts in seen] == [1, 1]
    monkeypatch.setattr(running, "ROWS_PER_RANGE", 100)
    assert sorted(map(str, mixing.mixing_plan(frame).collect())) == one and len(one) == 4500
    assert all(len(counts) > 30 and max(counts) < 300 for counts in seen[2:])
