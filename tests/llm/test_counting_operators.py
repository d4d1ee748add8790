"""Importance resampling, source divergence, byte-level BPE: against plain restatements and the tiktoken library."""

import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from cadenza.llm import byte_bpe, divergence, resampling

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
DOCS = "doc_id long, text string, lang string, source string, rank int, found string, key string"
PROSE = "The ship left port at 9, and the crew of the ship sang: one more port. "
ROWS = [(4, PROSE * 3, "en", "a", 1, "x", "k"), (2, None, "en", "b", 2, None, None), (9, "", None, None, 3, "y", "k"),
        (7, PROSE.upper() + "Été é 漢字 ", "en", "b", 4, "x", "k"), (None, "no id here " * 8, "en", None, 5, "x", None),
        (7, PROSE.upper() + "Été é 漢字 ", "en", "b", 4, "x", "k"), (12, "port ship\x00crew\x1f" * 4000, "fr", "a", 6, "x", "k"),
        *((i, f"port ship {'crew ' * (i % 4)} word{i % 3}", "en", "abc"[i % 3], i, "x", "k") for i in range(20, 45))]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def grams(text, n, buckets):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    return [zlib.crc32(" ".join(words[i:i + k]).encode()) % buckets for k in range(1, n + 1) for i in range(len(words) - k + 1)], len(words)


def resampled(rows, target, n, buckets, least, percent, seed):
    """(doc_id, n_features, weight, score, rank) by the definition; rank by score and doc_id."""
    found = [grams(r[1], n, buckets) for r in rows]
    wanted = Counter(b for t in target for b in grams(t, n, buckets)[0])
    have = Counter(b for f, _ in found for b in f)
    s, t = sum(have.values()), sum(wanted.values())
    gain = [math.floor(1000 * math.log((wanted[b] + 1) * (s + buckets) / ((have[b] + 1) * (t + buckets)))) for b in range(buckets)]
    out = []
    for r, (f, w) in zip(rows, found):
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest()[:8], 16)
        out.append([r[0], len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, w])
    able = sorted((x for x in out if x[5] >= least), key=lambda x: (-x[3], x[0] is None, x[0] or 0))
    for i, x in enumerate(able[:percent * len(able) // 100]):
        x[4] = i + 1
    return sorted((tuple(x[:5]) for x in out), key=str)


@pytest.mark.parametrize("n, buckets, least, percent", [(2, 10_000, 20, 25), (3, 100_000, 4, 60), (1, 7, 0, 100)])
def test_importance_equals_the_definition(spark, docs, n, buckets, least, percent):
    target = ["the crew sang", None, "One more PORT, one more ship"]
    side = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id int, text string")
    got = resampling.importance_ranks(docs, side, grams=n, buckets=buckets, min_words=least, percent=percent)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=str) == resampled(ROWS, target, n, buckets, least, percent, 7)


def test_sample_keeps_whole_rows(spark, docs):
    side = spark.createDataFrame([("one more port",)], "text string")
    drawn = resampling.importance_sample(docs, side, min_words=3, percent=50)
    ranks = resampling.importance_ranks(docs, side, min_words=3, percent=50, carry=("lang", "found", "key"))
    assert drawn.columns == docs.columns
    some = Counter(map(str, drawn.collect()))
    assert sum(some.values()) == ranks.where("rank is not null").count() > 5
    assert not some - Counter(map(str, docs.collect()))
    with pytest.raises(ValueError):
        resampling.importance_ranks(docs, side, carry=("rank",))


def test_importance_of_empty_tables(spark, docs):
    none = docs.where("false")
    assert resampling.importance_ranks(none, docs).collect() == []
    assert len(resampling.importance_ranks(docs, none).collect()) == len(ROWS)
    assert resampling.importance_sample(none, none).collect() == []


def test_many_equal_rows_are_ranked_one_by_one(spark):
    same = spark.range(3000).selectExpr("1L AS doc_id", "'a b c d e f' AS text").repartition(7)
    got = resampling.importance_ranks(same, same, min_words=1, percent=10)
    assert sorted(r["rank"] for r in got.where("rank is not null").collect()) == list(range(1, 301))


def sql_rows(rows):
    import pandas as pd
    con = duckdb.connect()
    frame = pd.DataFrame({"doc_id": range(len(rows)), "text": [r[1] for r in rows], "lang": [r[2] for r in rows], "source": [r[3] for r in rows]})
    con.register("frame", frame)
    con.sql("CREATE VIEW documents AS SELECT doc_id, CAST(text AS VARCHAR) AS text, CAST(lang AS VARCHAR) AS lang, CAST(source AS VARCHAR) AS source FROM frame")
    return sorted(con.sql(divergence.OP12_SQL).fetchall())


def test_divergence_equals_sql(docs):
    got = divergence.divergences(docs)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == sql_rows(ROWS)


def test_divergence_of_many_counts(spark):
    """More than 64 kept terms, counts of all sizes, a source that holds none of them."""
    rng = np.random.default_rng(3)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(150)]
    rows = [(i, " ".join(rng.choice(words, 80, p=np.arange(1, 151) / 11325)), "en", f"s{i % 5}") for i in range(60)]
    rows += [(99, "nothing known", "en", "none"), (100, None, "xx", "a"), (101, "b", "xx", "b")]
    got = divergence.divergences(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
    assert sorted(map(tuple, got.collect())) == sql_rows(rows)


def test_joint_cells_do_not_depend_on_tiles(monkeypatch):
    import pandas as pd
    rng = np.random.default_rng(5)
    bits = rng.integers(-2**63, 2**63 - 1, 40)
    rows = pd.DataFrame({"grp": [f"g{i % 6}" for i in range(40)], "p": rng.integers(1, 10**9, 40), "p0": 5, "bits": bits})
    whole = divergence.joint_cells(rows)
    monkeypatch.setattr(divergence, "TILE", 7)
    tiled = divergence.joint_cells(rows).groupby(["a", "b"], as_index=False)["value"].sum()
    pd.testing.assert_frame_equal(whole.sort_values(["a", "b"]).reset_index(drop=True), tiled)


def test_divergence_of_an_empty_table(docs):
    assert divergence.divergences(docs.where("false")).collect() == []


def test_share_is_exact_beyond_64_bits(spark):
    df = spark.createDataFrame([(3 * 10**15, 7 * 10**15 + 1, 12_345)], "count long, total long, kept long")
    assert df.select(divergence.share("count", "total", "kept").alias("p")).first().p == \
        1 + 10**9 * (3 * 10**15 + 2) // (7 * 10**15 + 1 + 2 * 12_345)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})


@settings(max_examples=200, deadline=None)
@given(text=st.one_of(st.text(), st.text(alphabet="aA \n\t\x1c\x85\xa0éß漢😀▁<unkow>\x00 ́0129'strelvd")))
def test_bpe_equals_the_library(library, text):
    bpe = byte_bpe.worker_model(RANKS, public_tokenizers.PATTERN)
    ids = bpe.encode([text])[0]
    assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)
    assert bpe.decode(ids) == text.encode()


def test_every_piece_is_its_own_encoding():
    bpe = byte_bpe.worker_model(RANKS, public_tokenizers.PATTERN)
    spelt = [p.decode("latin-1").translate(bpe.to_text) for p in bpe.pieces]
    assert bpe.model.encode(spelt, num_threads=1) == [[i] for i in range(len(spelt))]


def test_bpe_of_a_table(spark, docs, library):
    long = spark.createDataFrame([(1, "x" * 300_000 + " é" * 50_000)], "doc_id long, text string")
    rows = docs.unionByName(long, allowMissingColumns=True)
    tokens = byte_bpe.encode(rows, RANKS, public_tokenizers.PATTERN)
    back = byte_bpe.decode(tokens, RANKS, public_tokenizers.PATTERN)
    assert tokens.columns == ["doc_id", "n_tokens", "ids"] and back.columns == ["doc_id", "n_tokens", "decoded"]
    expect = [(r.doc_id, library.encode_ordinary(r.text or ""), (r.text or "").encode()) for r in rows.collect()]
    assert sorted(((r.doc_id, len(r.ids) // 4, np.frombuffer(r.ids, "<u4").tolist()) for r in tokens.collect()), key=str) == \
        sorted(((i, len(t), t) for i, t, _ in expect), key=str)
    assert sorted(((r.doc_id, r.n_tokens, bytes(r.decoded)) for r in back.collect()), key=str) == \
        sorted(((i, len(t), b) for i, t, b in expect), key=str)
    assert byte_bpe.encode(docs.where("false"), RANKS, public_tokenizers.PATTERN).collect() == []


def test_small_vocabulary_and_bad_ranks():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"bc": 257, b"abc": 258}
    bpe = byte_bpe.ByteBPE(ranks, r"[\s\S]+")
    assert np.frombuffer(bpe.encode(["abcab"])[0], "<u4").tolist() == [258, 256]
    assert np.frombuffer(bpe.encode(["bcbca"])[0], "<u4").tolist() == [257, 257, 97]
    with pytest.raises(ValueError):
        byte_bpe.model_bytes({b"a": 0})
