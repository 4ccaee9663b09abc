"""Very long texts through every operator and stage: whole, and in about linear time."""

import hashlib
import random
import time
import zlib

import corpus_pipeline
import pytest
from test_classifiers import BAD, corpus

from orderlens.llm import chat, quality, rules, sharding, simhash, toxicity

RND = random.Random(12)
DOCS, LABELS = corpus(600, 22)
VOCABULARY = sorted({w for _, t in DOCS for w in t.lower().split() if w.isalpha() and w not in BAD})
PROSE = " ".join(RND.choice(VOCABULARY) + RND.choice(["", "", "", ".", ",", "\n"]) for _ in range(250_000))
UNSPLIT = "".join(RND.choice("abcé漢") for _ in range(1_000_000))
LOOP = "the same words again\n" * 80_000


@pytest.fixture(scope="module")
def long_docs(spark):
    return spark.createDataFrame([(1, PROSE), (2, UNSPLIT), (3, LOOP), (4, PROSE), (5, "short and plain"), (6, None)], "doc_id long, text string")


def quick(run, seconds=25):
    start = time.process_time()
    out = run()
    assert time.process_time() - start < seconds
    return out


def test_rules():
    m = quick(lambda: rules.measure(PROSE))
    assert m["n_words"] == len(PROSE.split()) and m["word_chars"] == sum(map(len, PROSE.split())) and rules.verdict(m)
    m = quick(lambda: rules.measure(UNSPLIT))
    assert (m["n_words"], m["word_chars"]) == (1, len(UNSPLIT)) and rules.base_failed(m)
    m = quick(lambda: rules.measure(LOOP))
    assert m["n_dup_lines"] == 79_999 and rules.base_failed(m) and not rules.verdict(m)


def test_classifiers(spark, long_docs):
    docs, labels = DOCS, LABELS
    given = spark.createDataFrame(docs, "doc_id long, text string").union(long_docs.selectExpr("doc_id + 10000", "text"))
    given = given.union(spark.createDataFrame([(20000, PROSE + " " + " ".join(BAD * 2))], given.schema))
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    for module in (toxicity, quality):
        got = {r["doc_id"]: r["score"] for r in module.score(given, module.train(given, marks)).collect()}
        assert len(got) == len(docs) + 7 and got[10001] == got[10004]
        if module is toxicity:
            assert got[20000] > 0.5 and got[20000] > got[10001]  # the words stand at the very end


def test_fingerprints():
    a, b = quick(lambda: simhash.fingerprint(PROSE), 60), simhash.fingerprint(PROSE + " end")
    assert bin(a ^ b).count("1") <= 4 and quick(lambda: simhash.fingerprint(UNSPLIT)) != 0


def test_shards(long_docs):
    rows = {r["doc_id"]: r for r in sharding.shard(long_docs).collect()}
    for i, t in ((1, PROSE), (2, UNSPLIT), (3, LOOP), (6, None)):
        data = (t or "").encode()
        assert (rows[i]["size"], rows[i]["text_crc32"]) == (len(data) + 1, zlib.crc32(data))
    assert rows[1]["shard"] == rows[4]["shard"]


def test_chat(spark):
    turns = spark.createDataFrame([(1, 0, "user", PROSE), (1, 1, "assistant", UNSPLIT + "</s>\\"), (2, 0, "user", "</s>" * 100_000)], "conv_id long, turn long, role string, text string")
    made = chat.format_chat(turns)
    want = {r["conv_id"]: r for r in chat.digest(made).collect()}
    loss = UNSPLIT + "</s>\\"
    assert want[1]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest() and want[1]["loss_chars"] == len(loss)
    assert want[2]["turns_sha256"] == hashlib.sha256(("user\n" + "</s>" * 100_000 + "\n").encode()).hexdigest()
    # turns that were dealt out anew are put in order first
    again = {r["conv_id"]: r for r in chat.digest(chat.in_order(made.repartition(3, "position"))).collect()}
    assert again == want


def test_pipeline_stages(spark, long_docs, tmp_path):
    docs, labels = DOCS, LABELS
    secret = "token=" + "a1b2" * 10
    given = spark.createDataFrame(docs, "doc_id long, text string").union(long_docs.selectExpr("doc_id + 10000", "text"))
    given = given.union(spark.createDataFrame([(20000, PROSE + " " + secret)], given.schema))
    given.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    table = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {}
    for name, step in corpus_pipeline.STAGES[:-1]:
        kept[name] = {r["doc_id"]: r["text"] for r in step(spark, table, str(tmp_path)).collect()}
    assert all(t in (PROSE, UNSPLIT, LOOP, PROSE + " " + secret) for i, t in kept["toxicity"].items() if i in (10001, 10002, 10003, 10004, 20000))
    assert kept["quality_rules"][10001] == PROSE
    assert not {10002, 10003} & set(kept["quality_rules"])
    assert (10001 in kept["near_duplicates"]) and 10004 not in kept["near_duplicates"]
    assert kept["secrets"][20000] == PROSE + " [SECRET]"
    pieces = dict(corpus_pipeline.STAGES)["packing"](spark, table.where("doc_id in (10001, 10002)"), str(tmp_path))
    sums = {r["doc_id"]: (r["n"], r["t"]) for r in pieces.groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).toDF("doc_id", "n", "t").collect()}
    assert all(n == t > 200_000 for n, t in sums.values())
