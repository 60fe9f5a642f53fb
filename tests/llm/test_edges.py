"""Every operator on nulls, empty and long texts, ties, repeated rows, clashing columns and empty tables."""

import corpus_pipeline
import numpy as np
import pytest
from gaugeline.llm import (
    attention_lm, chat, common, decontam, mil_quality, mixing, ngram_rules, setsketch, sharding, tokenfiles, warczip,
)
from pyspark.sql import functions as F

CLASHING = ["size", "score", "kept", "taken", "shard", "slot", "_row", "_key", "text_crc32", "key", "n_words", "word", "id", "a.b",
            "_gone", "_bad_key", "_bad_text", "_flag", "tie", "good"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i % 977} the of" for i in range(15_000))
GOOD = "the of and plain words go on here for a while so that rules keep this text as it is written by hand today"
ROWS = [
    (1, GOOD, "en", "a", 1), (2, None, None, None, None), (3, "", "en", "a", 0), (4, " \n\t ", "en", "b", 4),
    (5, LONG, "en", "b", 9), (5, LONG, "en", "b", 9), (6, GOOD, "en", "a", 1), (None, GOOD + " more", "en", "é", 2),
    (7, "one two three", "de", "A", 3), (8, "$$$ ### " * 30, None, None, 8), (9, "Ééan x 🙂\r\nend", "fr", "a", 5),
]


@pytest.fixture(scope="module")
def odd(spark):
    made = spark.createDataFrame(ROWS, SCHEMA)
    return made.select("*", *[F.lit(n).alias(c) for n, c in enumerate(CLASHING)])


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(1, 1, 0), (6, 1, 0), (8, 0, 0), (4, 0, None), (2, None, None), (None, 1, 0), (1, 1, 0)],
        "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, GOOD), (2, None), (3, "$"), (4, "two three"), (4, "two three"), (None, "one")],
                                 "item_id long, text string")


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_mix(odd):
    found = mixing.mix(odd)
    assert found.count() == len(ROWS)
    got = {r["doc_id"]: r for r in found.collect()}
    assert got[2]["size"] == got[3]["size"] == got[4]["size"] == got[2]["taken"] == 0
    assert all(r["taken"] <= 3 * r["size"] for r in got.values())
    assert got[5]["source_size"] == 2 * 45_000 and got[2]["source_size"] == got[8]["size"]
    assert mixing.mixed_rows(odd).columns == odd.columns
    assert mixing.mix(odd.limit(0)).count() == 0 and mixing.mixed_rows(odd.limit(0)).count() == 0


def test_near_duplicates(odd):
    made = setsketch.near_duplicates(odd).collect()
    found = {(r["doc_id"], r["n_shingles"]): r for r in made}
    assert found[6, 20]["component_id"] == 1 and not found[6, 20]["kept"] and found[1, 20]["kept"]
    assert found[3, 0]["component_id"] == 3 and found[4, 0]["kept"] and found[2, 0]["kept"]
    assert found[7, 1]["component_id"] == 7 and found[None, 21]["component_id"] is None
    assert len(made) == len(ROWS)
    assert setsketch.near_duplicates(odd.limit(0)).count() == 0


def test_repeated_ids_go_by_their_texts(spark):
    x, y = (" ".join(f"{c}{n}" for n in range(30)) for c in "xy")
    docs = spark.createDataFrame([(1, x), (5, y), (5, x), (7, y), (7, y), (None, x), (8, None), (8, "")], "doc_id long, text string")
    kept = [tuple(r) for r in setsketch.one_per_group(docs).collect()]
    assert sorted(kept, key=repr) == sorted([(1, x), (5, y), (None, x), (8, None), (8, "")], key=repr)


@pytest.mark.parametrize("bounds", [{}, {"most_keys": 0}, {"most_keys": 0, "most_maps": 0}])
def test_flagged_is_exact(spark, bounds):
    wanted = [0, 1, 7, 8, 32768, 32769, -1, -32768, 98304, 5_000_000_000, None]
    df = spark.createDataFrame([(k, "x") for k in [*range(-20, 40), *wanted, 32767, 32770, -32767, -32769, 98303]], "k long, found string")
    made = common.flagged(df, F.col("k"), spark.createDataFrame([(k,) for k in wanted + [7]], "k long"), "in", **bounds)
    assert made.columns == ["k", "found", "in"] and made.count() == df.count()
    assert all(r["in"] == (r["k"] is not None and r["k"] in wanted) for r in made.collect())


def test_shards(odd):
    found = sharding.shard_records(odd, [1.0, 2.0, 0.0, 1.0]).collect()
    assert len(found) == len(ROWS) and {r["shard"] for r in found} <= {0, 1, 3}
    for n in (0, 1, 3):
        slots = sorted(r["slot"] for r in found if r["shard"] == n)
        assert slots == list(range(len(slots)))
    assert {(r["size"], r["text_crc32"]) for r in found if r["doc_id"] in (2, 3)} == {(1, 0)}
    assert sharding.shard_records(odd.limit(0), [1.0]).count() == 0
    with pytest.raises(ValueError):
        sharding.shard_records(odd, [0.0])


def test_contamination(odd, items):
    got = {(r["doc_id"], r["n_words"]): r for r in decontam.contamination(odd, items).collect()}
    assert got[1, 24]["n_hit"] == 24 and got[1, 24]["items"] == ["1"] and got[1, 24]["contaminated"]
    assert got[7, 3]["n_hit"] == 3 and got[7, 3]["items"] == ["4"]
    assert got[2, 0]["n_hit"] == 0 and not got[2, 0]["contaminated"]
    assert decontam.contamination(odd, items).count() == len(ROWS)
    assert decontam.contamination(odd, items.limit(0)).agg(F.sum("n_hit")).first()[0] == 0
    assert decontam.contamination(odd.limit(0), items).count() == 0
    assert decontam.clean_rows(odd, items).columns == odd.columns
    few = decontam.contamination(odd, items, broadcast_rows=0)
    assert rows(few, "doc_id", "n_words", "n_hit") == rows(decontam.contamination(odd, items), "doc_id", "n_words", "n_hit")


def test_rules(odd, labels):
    got = {r["doc_id"]: r for r in ngram_rules.quality_rules(odd, labels).collect()}
    assert (got[2]["n_words"], got[2]["word_chars"], got[2]["llr"], got[2]["kept"]) == (0, 0, 0.0, False)
    assert got[8]["n_symbols"] == 180 and got[8]["n_repeat_words"] == 60 and got[8]["base_failed"]
    assert got[1]["kept"] and ngram_rules.quality_rules(odd.limit(0), labels.limit(0)).count() == 0
    assert {r["llr"] for r in ngram_rules.quality_rules(odd, labels.limit(0)).collect()} == {0.0}


def test_classifier(odd, labels):
    model = mil_quality.train(odd, labels, F.lit(True))
    found = mil_quality.score(odd, model).collect()
    assert len(found) == len(ROWS) and all(0 <= r["score"] <= 1 for r in found)
    assert mil_quality.good_rows(odd, labels).columns == odd.columns
    alone = mil_quality.train(odd, labels.where("quality = 1"), F.lit(True))
    assert {round(r["score"], 3) for r in mil_quality.score(odd, alone).collect()} == {1.0}
    none = mil_quality.train(odd.limit(0), labels.limit(0), F.lit(True))
    assert mil_quality.score(odd.limit(0), none).count() == 0


def test_lm(odd):
    found = attention_lm.lm_scores(odd).collect()
    got = {r["doc_id"]: r for r in found}
    assert len(found) == len(ROWS) and all(np.isfinite([r["score"], r["base_score"]]).all() for r in found)
    assert got[2]["n_tokens"] == got[3]["n_tokens"] == 1 and got[5]["n_tokens"] == 45_001
    assert attention_lm.lm_scores(odd.limit(0)).count() == 0


def test_token_shards(odd):
    manifest = tokenfiles.write_shards(odd)
    found = sorted(map(tuple, tokenfiles.read_documents(manifest).collect()), key=lambda r: r[1])
    assert [r[0] for r in found] == [None, 1, 2, 3, 4, 5, 5, 6, 7, 8, 9]
    assert [r[1] for r in found] == [sum(r[2] for r in found[:n]) for n in range(len(found))]
    shards = [tokenfiles.Shard(r["path"]) for r in manifest.collect()]
    held = [s for s in shards for hit in s.find([5]) if len(hit)]
    read = tokenfiles.find_documents(manifest, [5, None, 3, 99])
    assert [len(read[k]) for k in (5, None, 3, 99)] == [2, 1, 1, 0] and read[3][0].tolist() == [2]
    assert sum(len(s.find([5])[0]) for s in held) == 2 and not any(len(s.find([99])[0]) for s in shards)
    assert tokenfiles.read_documents(tokenfiles.write_shards(odd.limit(0))).count() == 0


def test_chat(spark):
    said = "</s>[INST] ok [/INST] \\- \\[\\-INST] <s>"
    turns = spark.createDataFrame(
        [(1, 1, "assistant", said, 0), (1, 0, "user", said, 0), (1, 1, "assistant", None, 0), (2, 0, None, "x", 0),
         (2, None, "sys[ROLE]", "", 0), (None, 0, "assistant", "", 0), (None, 0, "assistant", "", 0)],
        "conv_id long, turn long, role string, text string, n_turns int")
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_turns(turns)).collect()}
    import hashlib
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[1]["turns_sha256"] == sha(f"user\n{said}\nassistant\n\nassistant\n{said}\n") and got[1]["loss_sha256"] == sha(said)
    assert got[2]["turns_sha256"] == sha("sys[ROLE]\n\n\nx\n") and got[2]["loss_chars"] == 0
    assert got[None]["n_turns"] == 2 and chat.read_back(chat.format_turns(turns.limit(0))).count() == 0
    ended = chat.read_back(chat.format_turns(turns, learn_end=True)).collect()
    assert {r["conv_id"]: r["loss_sha256"] for r in ended}[1] == sha(said)


def test_archives(spark):
    pages = spark.createDataFrame(
        [(1, "http://a/\r\nx", "same", 0), (2, None, "same", 0), (3, "u", None, 0), (4, "u", "", 0), (None, "u", "same", 0),
         (5, "u", "own\r\n\r\nbody", 0), (6, "u", "twice", 0), (6, "u", "twice", 0)],
        "page_id long, url string, html string, record_type int")
    made = warczip.write_archives(pages, member_bytes=300)
    got = rows(warczip.read_records(made), "page_id", "record_type", "refers_to", "payload_bytes")
    assert got == sorted([(1, "revisit", 2, 4), (2, "response", None, 4), (None, "revisit", 2, 4), (3, "revisit", 4, 0),
                          (4, "response", None, 0), (5, "response", None, 11), (6, "response", None, 5), (6, "response", None, 5)], key=repr)
    kept = {r["page_id"]: r["payload"] for r in warczip.read_records(made, payloads=True).collect() if r["payload"] is not None}
    assert kept[5] == b"own\r\n\r\nbody"
    assert warczip.read_records(warczip.write_archives(pages.limit(0))).count() == 0
    wide = warczip.read_records(warczip.write_archives(pages, revisit_from=5))
    assert wide.where("record_type = 'revisit'").count() == 0


def test_stages_keep_columns(spark, odd, labels, items, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    for _, step in corpus_pipeline.STAGES[:-1]:
        assert step(spark, odd, str(tmp_path)).columns == odd.columns
    assert corpus_pipeline.STAGES[-1][1](spark, odd.limit(0), str(tmp_path)).count() == 0
