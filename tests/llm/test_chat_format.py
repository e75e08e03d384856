"""Chat formatting against plain Python: round trip, spans, hot conversations."""

import random
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from importlens.llm import chat_format as cf

SCHEMA = "conv_id long, turn long, role string, text string"
PIECES = [*cf.CONTROLS, "\\", "\\\\", "<", "[", "|", "/", "s>", "<\\/s>", "[\\INST]", "\n", "$1", "ü𝄞", "<|", "im_end|>", ""]


def _rows(seed):
    rng = random.Random(seed)

    def text():
        return rng.choice([None, "", "ok"]) if rng.random() < 0.2 else "".join(rng.choices(PIECES, k=rng.randrange(8)))
    rows = [(c, t, rng.choice(["user", "assistant", "system", None, "", "<|im_sep|>\\", "Assistant"]), text())
            for c in [None, *range(60)] for t in rng.sample([None, *range(12)], rng.randrange(12))]
    rows += [(100, t, "assistant" if t % 2 else "user", f"turn {t} </s>") for t in range(1500)]      # most of the rows
    return rows + [(101, 0, "assistant", "<s>long\\ " * 100_000)] + rows[:6]                          # repeated rows


def _key(r):
    return (r[1] is not None, r[1] or 0, (r[2] or "").encode(), sha256((r[3] or "").encode()).hexdigest())


def _conversations(rows):
    out = {}
    for r in sorted(rows, key=_key):
        out.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    return out


def test_digests_match_python(spark):
    rows = _rows(1)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as position", "2 as formatted", "3 as stream_end", "4 as part").repartition(5)
    got = {r.conv_id: r for r in cf.digests(cf.stream(df)).collect()}
    want = _conversations(rows)
    assert set(got) == set(want)
    for conv, turns in want.items():
        learned = "".join(t for r, t in turns if r == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256) == (len(turns), sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()), conv
        assert (r.loss_chars, r.loss_sha256) == (len(learned), sha256(learned.encode()).hexdigest()), conv


def test_examples_are_prefixes(spark):
    rows = _rows(2)
    turns = cf.stream(spark.createDataFrame(rows, SCHEMA).repartition(5))
    streams = {}
    for r in sorted(turns.collect(), key=lambda r: r.position):
        streams[r.conv_id] = streams.get(r.conv_id, "") + r.formatted
        assert r.stream_end == len(streams[r.conv_id])
        assert r.formatted.count(cf.START) == r.formatted.count(cf.SEP) == r.formatted.count(cf.END) == 1
        bare = r.formatted[len(cf.START):-len(cf.END)].replace(cf.SEP, "", 1)
        assert not any(c in bare for c in cf.CONTROLS)
    found = cf.examples(turns)
    want = _conversations(rows)
    assert found.count() == sum(r == "assistant" for t in want.values() for r, _ in t)
    some = found.where("conv_id < 60 or conv_id is null")
    for e in cf.example_texts(turns, some).collect():
        assert e.text == streams[e.conv_id][:e.length] and e.text.endswith(cf.END)
        assert e.text.count(cf.START) == e.context_turns + 1 == e.example
        covered = e.text[e.loss_start:e.loss_end]
        assert covered.replace("\\\\", "\0").replace("\\", "").replace("\0", "\\") == want[e.conv_id][e.example - 1][1]


def test_escape_round_trip(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choices(PIECES, k=rng.randrange(12))) for _ in range(3000)] + ["<<SYS>>", "<<</SYS>>", "<<s>", "[[/INST]"]
    out = spark.createDataFrame([(t,) for t in texts], "t string").select("t", cf.escaped(F.col("t")).alias("e")).withColumn(
        "back", cf.unescaped(F.col("e"))).collect()
    for r in out:
        assert r.back == r.t and not any(c in r.e for c in cf.CONTROLS), r.t


def test_sample_and_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert cf.stream(empty).collect() == []
    rows = cf.digests(cf.stream(cf.with_sample(empty))).collect()
    said = cf.SAMPLE_TEXT
    assert [(r.conv_id, r.n_turns, r.loss_chars, r.turns_sha256) for r in rows] == [
        (-1, 2, len(said), sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest())]


def test_only_sql_functions(spark):
    turns = cf.stream(spark.createDataFrame(_rows(4)[:20], SCHEMA))
    plan = cf.digests(turns)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "MapIn", "CartesianProduct", "NestedLoop"))


def test_loss_is_read_from_the_examples(spark):
    rows = _rows(5)
    turns = cf.stream(spark.createDataFrame(rows, SCHEMA).repartition(5))
    chosen = cf.examples(turns).where("example > 2")
    got = {r.conv_id: r for r in cf.digests(turns, chosen).collect()}
    for conv, said in _conversations(rows).items():
        learned = "".join(t for r, t in said[2:] if r == "assistant")
        assert (got[conv].n_turns, got[conv].loss_chars) == (len(said), len(learned)), conv
        assert got[conv].loss_sha256 == sha256(learned.encode()).hexdigest(), conv


def test_query_builds_the_examples(spark, tmp_dir):
    rows = [(c, t, "assistant" if t % 2 else "user", f"said {t}") for c in (1, None) for t in range(5)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(tmp_dir + "/conversations.parquet")
    out = cf.op11_chat_format(spark, tmp_dir)
    files = {f.rsplit("/", 1)[0] for f in out.inputFiles() if "/chat-examples-" in f}
    assert len(files) == 1
    found = spark.read.parquet(files.pop()).collect()
    assert sorted((r.conv_id or 0, r.example, r.context_turns) for r in found) == [
        (c, e, e - 1) for c in (-1, 0, 1) for e in ((2,) if c < 0 else (2, 4))]
    assert {r.conv_id: r.loss_chars for r in out.collect()} == {-1: len(cf.SAMPLE_TEXT), 1: 12, None: 12}


@pytest.mark.parametrize("part_chars", [cf.PART_CHARS, 50])
def test_every_example_is_written_whole(spark, tmp_dir, monkeypatch, part_chars):
    monkeypatch.setattr(cf, "PART_CHARS", part_chars)       # 50: a conversation's examples are written by several tasks
    rows = [(c, t, "assistant" if t % 2 else "user", f"said {t} </s>") for c in (1, None) for t in range(9)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(tmp_dir + "/conversations.parquet")
    out = cf.op11_chat_format(spark, tmp_dir)
    files = {f.rsplit("/", 1)[0] for f in out.inputFiles() if "/chat-examples-" in f}
    found = [r for r in spark.read.parquet(files.pop()).collect() if r.conv_id != cf.SAMPLE_ID]
    turn = [f"{cf.START}{'assistant' if t % 2 else 'user'}{cf.SEP}said {t} <\\/s>{cf.END}" for t in range(9)]
    assert sorted((r.conv_id or 0, r.text) for r in found) == sorted((c, "".join(turn[:n])) for c in (0, 1) for n in (2, 4, 6, 8))
    assert all(r.text[r.loss_start:r.loss_end] == f"said {r.example - 1} <\\/s>" and r.length == len(r.text) for r in found)
    assert {r.loss_chars for r in out.collect() if r.conv_id != cf.SAMPLE_ID} == {4 * len("said 1 </s>")}
