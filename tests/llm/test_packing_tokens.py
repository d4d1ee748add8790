"""Token files, packing, token counts: against the tokenizers library and plain arithmetic."""

import brute
import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cadenza.llm import binary_tokens, common, packing, token_counts
from cadenza.llm.tokens import encoder

WORD = public_tokenizers.path("word_bpe_49k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id long, text string, lang string, rank int, cls string"
ROWS = [(5, "The cat, sat. On <|endoftext|> it's 1,000.5!", "en", 1, "x"), (2, None, None, None, None), (9, "", "en", 2, "y"),
        (2, "again " * 3000, "en", 3, "z"), (7, "É. é J̌,. a.,b  x́", None, 1, "x"), (None, "no id", "en", 1, "x"),
        (5, "The cat, sat. On <|endoftext|> it's 1,000.5!", "en", 1, "x"), (11, "x" * 30000, "en", 1, "x")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS)


def whole(text, end=None):
    return encoder(WORD).tokenizer.encode(text or "", add_special_tokens=False).ids + ([] if end is None else [end])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(), st.text(alphabet="aA,.<|>endoftx '̌Jé1 \n")), max_size=6))
def test_piecewise_encoding_equals_the_library(texts):
    ids, offsets = encoder(WORD).encode(pa.array(texts, pa.string()), 1)
    for i, t in enumerate(texts):
        assert ids[offsets[i]:offsets[i + 1]].tolist() == whole(t, 1)


def test_token_files_round_trip(spark, docs, tmp_path):
    folder = f"file://{tmp_path}/tokens"
    manifest = binary_tokens.write_token_files(docs, folder, WORD, 1, shards=3)
    back = {r.doc_no: r for r in binary_tokens.read_token_files(spark, folder, with_ids=True).collect()}
    order = sorted(range(len(ROWS)), key=lambda i: (ROWS[i][0] is not None, ROWS[i][0] or 0))
    assert [back[n].doc_id for n in sorted(back)] == [ROWS[i][0] for i in order]
    start, expect = 0, {}
    for r in (back[n] for n in sorted(back)):
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), brute.crc(ids))
        expect.setdefault(r.doc_id, []).append(ids)
        start += len(ids)
    for key in {r[0] for r in ROWS}:
        assert sorted(expect[key]) == sorted(whole(r[1], 1) for r in ROWS if r[0] == key)
    total = sum(r.n_tokens for r in manifest.collect())
    files = b"".join((tmp_path / "tokens" / f"shard-{r.shard:05d}.bin").read_bytes()
                     for r in sorted(manifest.collect(), key=lambda r: r.shard))
    assert total == start and len(files) == 2 * start  # 49,408 ids fit uint16


def test_empty_table(spark, docs, tmp_path):
    none = docs.where("false")
    binary_tokens.write_token_files(none, f"file://{tmp_path}/t", WORD, 1)
    assert binary_tokens.read_token_files(spark, f"file://{tmp_path}/t").count() == 0
    assert packing.pack(packing.token_pieces(none, WORD, 2, 64), 64).count() == 0
    assert token_counts.token_counts(none, PIECE).count() == 0


def check_packed(rows, length):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by_sequence.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= length
    return len(by_sequence)


@pytest.mark.parametrize("length", [64, 1031, 4096])
def test_packing_places_every_id_once(spark, docs, length):
    rows = packing.pack(packing.token_pieces(docs, WORD, 2, length, with_ids=True), length).collect()
    n = check_packed(rows, length)
    expect = sorted(brute.crc(ids[s:s + length]) for _, t, *_ in ROWS for ids in [whole(t, 2)] for s in range(0, len(ids), length))
    assert sorted(r.ids_crc32 for r in rows) == expect
    total = sum(len(whole(t, 2)) for _, t, *_ in ROWS)
    assert n <= -(-total // length) + 3
    out = packing.sequences(spark.createDataFrame(rows), length, 0).collect()
    assert all(len(r.ids) == 4 * length for r in out) and sum(r.n_tokens for r in out) == total


def test_one_length_holds_most_pieces(spark):
    """A class with nearly all rows, all alike, is ranked exactly and spread over tasks."""
    same = spark.range(4000).selectExpr("7L doc_id", "0L start", "10L length", "1L ids_crc32", "10L doc_tokens")
    other = spark.range(50).selectExpr("id doc_id", "0L start", "40 + id length", "2L ids_crc32", "40 + id doc_tokens")
    rows = packing.pack(same.union(other), 96).collect()
    assert len(rows) == 4050
    n = check_packed(rows, 96)
    assert n <= 1.12 * sum(r.length for r in rows) / 96


def test_column_generation_reaches_the_known_optimum():
    size, demand = np.array([3, 4, 5, 9]), np.array([40.0, 25.0, 12.0, 7.0])
    patterns, x = packing.generate_columns(size, demand, 12, gap=0)
    assert np.allclose(patterns @ x, demand) and (size @ patterns <= 12).all()
    assert x.sum() < sum(demand * size) / 12 + 1.01
    value, column = packing.priced_pattern(np.array([0.2, 0.34, 0.4, 0.9]), size, 12)
    best = max(0.2 * a + 0.34 * b + 0.4 * c + 0.9 * d for a in range(5) for b in range(4) for c in range(3) for d in range(2)
               if 3 * a + 4 * b + 5 * c + 9 * d <= 12)
    assert abs(value - best) < 1e-9 and column @ size <= 12


def test_trie_counts_equal_the_unigram_library():
    from tokenizers import Tokenizer, models

    scores = token_counts.zipf_scores(PIECE)
    library = Tokenizer(models.Unigram([("<unk>", 0.0), *scores.items()], 0, False))
    words = [token_counts.MARK + w for w in ("the theme themes internationalisation übergrößenträger aaaaaaaaaaaa "
                                             "supercalifragilistic x 1234567 don't ,,.. naïveté").split()]
    trie = token_counts.Trie(scores)
    for _ in range(2):  # the second time every prefix is there
        assert [trie.count(w) for w in words] == [len(e.ids) for e in library.encode_batch(words)]
    assert len(trie.best) < 1 + sum(map(len, words))
    assert trie.count("\U0001f9ff") == 4  # an unknown code point: its bytes


def test_token_counts(spark, docs):
    trie = token_counts.Trie(token_counts.zipf_scores(PIECE))
    got = sorted((r.doc_id or -1, r.n_pretokens, r.n_tokens) for r in token_counts.token_counts(docs, PIECE).collect())
    split = [(r[0] or -1, [w for w in (r[1] or "").replace("\n", " ").split(" ") if w]) for r in ROWS]
    assert got == sorted((k, len(w), sum(trie.count(token_counts.MARK + x) for x in w)) for k, w in split)


def test_slices_keep_all_rows_in_order():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * n for n in (5, 0, 90, 3, 200, 1)] + [None]})
    parts = list(common.slices(batch, "text", 64))
    assert [t for p in parts for t in p.column("text").to_pylist()] == batch.column("text").to_pylist()
    assert len(parts) > 1


@pytest.mark.parametrize("lengths", [[1], [2, 3, 4], [11], [1, 60, 61, 199, 204, 205, 206, 700], list(range(1, 300))])
def test_little_padding_on_short_pieces(spark, lengths):
    """Empty texts, texts of one to three words, of ten words: what is not tokens is below a twentieth."""
    length = f"element_at(array({', '.join(map(str, lengths))}), cast(id % {len(lengths)} + 1 as int))"
    rows = spark.range(20_000).selectExpr("id doc_id", "0L start", f"cast({length} as long) length", "1L ids_crc32", f"cast({length} as long) doc_tokens")
    got = packing.pack(rows, 4096).collect()
    assert len(got) == 20_000 and len({r.doc_id for r in got}) == 20_000
    n = check_packed(got, 4096)
    total = sum(r.length for r in got)
    assert n <= max(-(-total // 4096) + 1, total / 4096 / 0.95)


def test_bundles_and_the_rest_fill_their_classes():
    own = packing.bundled_classes({-3: 25, -17: 9, -40: 11, 3: 4, 4: 2}, 10, 40)
    assert own.demand == {3: 4 + 2, 4: 2 + 1, 40: 1, 1: 5, 2: 9}
    pieces = [(k, r) for k, n in ((-3, 25), (-17, 9), (-40, 11), (3, 4), (4, 2)) for r in range(n)]
    cls, place, inner = own.places(*(np.array(x) for x in zip(*pieces)))
    seen = {}
    for (k, _), c, p, i in zip(pieces, cls.tolist(), place.tolist(), inner.tolist()):
        seen.setdefault((c, p), []).append((k, i))
    assert {c: len({p for d, p in seen if d == c}) for c in own.demand} == own.demand
    assert all(sum(-k if k < 0 else 10 * c for k, _ in held) <= 10 * c and len({i for _, i in held}) == len(held) for (c, _), held in seen.items())


def test_counts_stay_right_when_the_trie_starts_again(monkeypatch):
    scores = token_counts.zipf_scores(PIECE)
    words = [token_counts.MARK + w for w in "one two three the theme themes there internationalisation the one é漢 theme".split()]
    expect = token_counts.Trie(scores).counts(words).tolist()
    monkeypatch.setattr(token_counts, "TRIE_NODES", 10)
    trie = token_counts.Trie(scores)
    for _ in range(4):
        assert [int(trie.counts([w])[0]) for w in words] == expect
    inserted = []
    real = trie.insert
    trie.insert = lambda w: inserted.append(w) or real(w)
    trie.counts(words)
    trie.counts(words[:3])
    assert set(words[:3]).isdisjoint(inserted[len(set(words)):])  # met in the generation before: moved over, not scored again


def test_hadoop_schemes_as_arrow_names_them():
    names = {"s3a://b/x": "s3://b/x", "s3n://b/x": "s3://b/x", "s3://b/x": "s3://b/x", "gs://b/x": "gs://b/x", "file:/t/x": "file:/t/x",
             "file:///t/x": "file:///t/x", "/t/x": "file:///t/x", "/t/a:b": "file:///t/a:b", "hdfs://n:9/x": "hdfs://n:9/x"}
    assert {k: binary_tokens.arrow_uri(k) for k in names} == names
