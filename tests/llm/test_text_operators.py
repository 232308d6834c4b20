"""Mixing, sharding, packing, personal data and quality rules on small tables with every edge."""

import json
import random
import zlib

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sluice.llm.mixing import mixed_documents, source_targets, systematic_mix, word_count
from sluice.llm.packing import cuts, pack_documents
from sluice.llm.pii import KINDS, find_pii, redact, span_text
from sluice.llm.quality_rules import keep_good, vote_quality
from sluice.llm.queries import vocabulary_path
from sluice.llm.shards import balanced_shards, byte_size, write_shards
from sluice.llm import token_matrix as matrices
from sluice.llm.token_matrix import best_fit_decreasing, position_ids, read_token_matrix, token_matrix, write_token_matrix
from sluice.llm.tokens import encoder
from sluice.llm.voting import fit

DOCS = "doc_id long, text string, lang string, source string, n_chars long, run int, row long, doc string, size string, stats string"
PII = ("mail a.b@c.de, x@y.z@w.v-u.t a@b .c_d@e.fé.g 1.2.3.4 1.2.3.4.5 256.1.1.1 01.002.3.4 1.2.3 4111 1111 1111 1111 "
       "4111-1111-1111-1112 5500005555555559 12--34 0000000000000 +1 (415) 555-2671 +12 +1234567890123456 +44 20 7946 0958) "
       "call (415) 555-2671 now \U0001f600 a.b.c+d%e@mail-1.example.co.uk. 378282246310005")


def table(spark, texts, **more):
    rows = [(i, t, "en", f"s{i % 3}", None, 1, 2, "d", "z", "y") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def edge_texts():
    rng = random.Random(5)
    words = ["alpha", "beta", "gamma", "delta", "café", "naïve", "\U0001f600", "x1", "don't", "the", "of"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 400))) for _ in range(40)]
    return [None, "", " \t\n", "one", PII, "a b c d e " * 30, "x" * 30_000, "line one here\n" * 20, *texts, texts[0], texts[0],
            "w " * 5000, "<|endoftext|> tail", "1" * 3000, "a." * 3000 + "@", "+1" + "(" * 3000, "@" * 500 + "a@b.c"]


# voting


def test_votes_recover_the_accuracies():
    rng = random.Random(1)
    accuracy = {"a": (0.95, 0.8), "b": (0.9, 0.6), "c": (0.85, 0.7), "d": (0.98, 0.5)}
    patterns = {}
    for _ in range(40_000):
        good = rng.random() < 0.8
        votes = tuple(None if rng.random() < 0.2 else int((rng.random() < accuracy[r][0]) if good else (rng.random() >= accuracy[r][1])) for r in accuracy)
        patterns[votes] = patterns.get(votes, 0) + 1
    model = fit(sorted(patterns.items(), key=str), list(accuracy), {r: (0.8, 0.5) for r in accuracy}, 0.7)
    assert abs(model.prior - 0.8) < 0.05
    for r, (yes, no) in accuracy.items():
        assert abs(model.accuracy[r][0] - yes) < 0.06 and abs(model.accuracy[r][1] - no) < 0.12
    empty = fit([], ["a"], {"a": (0.9, 0.4)}, 0.7)
    assert empty.prior == pytest.approx(0.7) and empty.accuracy["a"] == pytest.approx((0.9, 0.4))


# quality rules


def test_quality_rules_match_brute_force(spark):
    texts = edge_texts()
    judged, _ = vote_quality(table(spark, texts))
    got = {r.doc_id: r for r in judged.collect()}
    for i, text in enumerate(texts):
        s = got[i].stats
        assert (s.n_words, s.word_chars, s.n_symbols, s.n_dup_lines, s.n_repeat_words, got[i].base_failed) == brute.quality_base(text), text[:50]
        assert 0 <= got[i].posterior <= 1 and not (got[i].base_failed and got[i].kept)


def test_quality_rules_keep_prose_and_drop_junk(spark):
    rng = random.Random(2)
    syllables = ["ta", "re", "mi", "son", "ver", "lo", "ka", "den", "stra", "ple", "un", "es"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    prose = lambda: ". ".join(" ".join(word() for _ in range(12)).capitalize() for _ in range(6)) + "."
    good = [prose() for _ in range(60)]
    bad = [" ".join(word() + "###" for _ in range(80)) for _ in range(8)] + [" | ".join(word() for _ in range(80)) for _ in range(8)]
    docs = table(spark, good + bad)
    kept = keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == list(range(60))
    assert keep_good(docs.limit(0)).count() == 0


# personal data


def found(df):
    base = F.filter("spans", lambda s: s["base"])
    return {r.doc_id: r for r in df.select("doc_id", span_text(base).alias("base"), span_text(F.col("spans")).alias("all")).collect()}


def test_personal_data_matches_brute_force(spark):
    texts = edge_texts()
    rng = random.Random(4)
    pieces = ["a", "@", ".", "b.c", "1", "23", " ", "-", "+", "(", "4111111111111111", "é", "1.2.3.4", "555-2671", "a@b.c", "_", "\n"]
    texts += ["".join(rng.choice(pieces) for _ in range(rng.randint(5, 60))) for _ in range(400)]
    got = found(find_pii(table(spark, texts).select("doc_id", "text"), drop_text=True))
    for i, text in enumerate(texts):
        want = brute.base_spans(text)
        assert got[i].base == ",".join(f"{k}:{a}:{b}" for k, a, b in want), (text, got[i].base)
        assert set(filter(None, got[i].base.split(","))) <= set(filter(None, got[i]["all"].split(",")))


def test_weak_labels_add_spans(spark):
    local = "please call (415) 555-2671 or write to jane [at] example [dot] com today"
    card = "the number 4111111111111112 was read out"
    plain = "version 3.0 of chapter 12 was printed in 1998 and 2004"
    texts = [local, card, plain] + [f"text {i} mail u{i}@site{i}.com phone +1 (415) 555-{1000 + i} ip 10.0.0.{i}" for i in range(30)]
    got = found(find_pii(table(spark, texts).select("doc_id", "text")))
    assert got[0]["all"] == f"email:{local.index('jane')}:{local.index(' today')},phone:{local.index('(')}:{local.index(' or')}"
    assert got[1]["all"] == f"card:{card.index('4')}:{card.index(' was')}"
    assert got[2]["all"] == ""


def test_redaction_replaces_all_spans(spark):
    texts = [None, "", "no data", "a@b.co and 1.2.3.4, twice a@b.co", "+1 4111111111111111 end", "\U0001f600\U0001f600 a@b.co \U0001f600"]
    docs = table(spark, texts).withColumn("n_chars", F.length("text").cast("long"))
    rows = {r.doc_id: r for r in redact(docs).collect()}
    assert redact(docs).schema == docs.schema
    assert [rows[i].text for i in range(6)] == [None, "", "no data", "[EMAIL] and [IP], twice [EMAIL]", rows[4].text, "\U0001f600\U0001f600 [EMAIL] \U0001f600"]
    assert "4111" not in rows[4].text and rows[3].n_chars == len(rows[3].text) and rows[2].n_chars == 7
    assert redact(docs.limit(0)).count() == 0 and len(KINDS) == 4


# mixing


def water_fill(sizes, weights, cap):
    """Repeat: share what is left by weight, stop sources at their cap."""
    total, target, open_ = sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    left = float(total)
    while open_:
        share = left / sum(weights[i] for i in open_)
        full = {i for i in open_ if share * weights[i] > cap * sizes[i]}
        if not full:
            for i in open_:
                target[i] = share * weights[i]
            return target
        for i in full:
            target[i] = cap * sizes[i]
            left -= target[i]
        open_ -= full
    return target


@pytest.mark.parametrize("sizes", [[100, 100, 100], [1, 50, 1000, 3], [0, 10, 10], [7], [5, 5000, 2, 9, 0, 3], [0, 0]])
def test_targets_are_shared_again(spark, sizes):
    names = [f"s{i}" for i in range(len(sizes) - 1)] + [None]
    got = {r.source: r.target for r in source_targets(
        spark.createDataFrame(list(zip(names, sizes)), "source string, source_size long"), (1, 2, 3), 3).collect()}
    want = water_fill(sizes, [(1, 2, 3)[i % 3] for i in range(len(sizes))], 3)
    assert [got[n] for n in names] == pytest.approx(want)


def test_mix_comes_near_its_targets(spark):
    rows = spark.range(6000).select(
        F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 30 == 0, F.lit(None)).otherwise(F.concat(F.lit("s"), F.col("id") % 4)).alias("source"),
        F.when(F.col("id") % 50 > 0, F.col("id")).alias("doc_id"), (F.pmod(F.xxhash64("id"), F.lit(300)) + F.col("id") % 7 * 40).alias("size"))
    mixed = systematic_mix(rows)
    again = sorted(map(str, systematic_mix(rows.repartition(7)).collect()))
    got = mixed.collect()
    assert sorted(map(str, got)) == again and len(got) == 6000 and all(0 <= r.copies <= 3 for r in got)
    taken = {}
    for r in got:
        t = taken.setdefault(r.source, [r.target, r.source_size, 0])
        t[2] += r.copies * r.size
        assert r.copies in (int(r.target / r.source_size), int(r.target / r.source_size) + 1)
    assert sum(t[0] for t in taken.values()) == pytest.approx(sum(r.size for r in got))
    for target, _, words in taken.values():
        assert abs(words - target) <= 0.01 * target + 300
    assert systematic_mix(rows.limit(0)).count() == 0


def test_mixed_documents_keep_their_columns(spark):
    docs = table(spark, edge_texts())
    out = mixed_documents(docs)
    assert out.columns == docs.columns
    sizes = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    want = {r.doc_id: r.copies for r in systematic_mix(sizes).collect() if r.copies}
    assert {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()} == want


# shards


def test_shards_are_contiguous_and_balanced(spark, tmp_path):
    texts = edge_texts() * 5 + ["copy of a text"] * 200
    docs = table(spark, texts).withColumn("doc_id", F.when(F.col("doc_id") % 9 > 0, F.col("doc_id")))
    rows = docs.select("doc_id", byte_size(F.col("text")).alias("size"), F.xxhash64("text").alias("digest"))
    got = balanced_shards(rows, 8, [F.col("digest"), F.col("doc_id")]).collect()
    assert len(got) == len(texts)
    total, largest = sum(r.size for r in got), max(r.size for r in got)
    assert sum(len((t or "").encode()) + 1 for t in texts) == total
    for s in range(8):
        mine = [r for r in got if r.shard == s]
        assert sorted(r.slot for r in mine) == list(range(len(mine)))
        assert abs(sum(r.size for r in mine) - total / 8) <= largest
    order = [r.digest for r in sorted(got, key=lambda r: (r.shard, r.slot))]
    assert order == sorted(order)
    assert balanced_shards(rows.limit(0), 8, [F.col("digest")]).count() == 0
    write_shards(docs, str(tmp_path / "s"), 4, [F.xxhash64("text")])
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == len(texts) and set(docs.columns) <= set(back.columns) and len(list((tmp_path / "s").glob("shard=*"))) == 4


# packing


def test_cuts_cover_the_document():
    for n in range(1, 5000, 7):
        pieces = cuts(n, 1024, 0.02)
        assert sum(pieces) == n and all(0 < p <= 1024 for p in pieces)
        for p in pieces[:-1]:
            assert (1024 // p) * p > 1024 - 1024 // p


def test_ids_are_those_of_the_vocabulary():
    slow, fast = Tokenizer.from_file(vocabulary_path()), encoder(vocabulary_path())
    for text in [t or "" for t in edge_texts()] + ["   x", "ﬁ Ⅷ ²³ ́", "  \n\n  y", "don't DON'T 's", "日本語 한국어 ‮"]:
        assert fast(text).tolist() == slow.encode(text, add_special_tokens=False).ids, text[:40]


def test_packing_is_a_round_trip(spark):
    texts = edge_texts()
    docs = table(spark, texts).repartition(3)
    rows = pack_documents(docs, vocabulary_path(), with_ids=True).collect()
    encode = encoder(vocabulary_path())
    for i, text in enumerate(texts):
        own = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.start)
        ids = [*encode(text or "").tolist(), 0]
        assert [x for r in own for x in r.ids] == ids and all(r.doc_tokens == len(ids) for r in own)
        assert [r.start for r in own] == list(np.cumsum([0] + [r.length for r in own[:-1]]))
        assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and r.length == len(r.ids) for r in own)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append(r)
    for own in sequences.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == list(np.cumsum([0] + [r.length for r in own[:-1]])) and sum(r.length for r in own) <= 1024
    assert sum(r.length for r in rows) / (1024 * len(sequences)) > 0.9
    assert pack_documents(docs.limit(0), vocabulary_path()).count() == 0
    assert json.dumps(sorted(map(str, pack_documents(docs, vocabulary_path()).collect())))


def test_the_packing_stage_sends_few_texts_at_a_time(spark, monkeypatch):
    """Arrow batches of the session's size would take hundreds of MB beside the heap and in each worker."""
    import pyarrow as pa

    import corpus_pipeline

    def sizes(docs, vocabulary, **options):
        count = lambda batches: (pa.RecordBatch.from_pydict({"n": pa.array([b.num_rows], pa.int64())}) for b in batches)
        return docs.mapInArrow(count, "n long")

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    monkeypatch.setattr(corpus_pipeline, "pack_documents", sizes)
    spark.conf.set(key, "10000")
    try:
        docs = spark.range(3000).selectExpr("id AS doc_id", "'text' AS text").coalesce(1)
        found = [r.n for r in corpus_pipeline.pack(spark, docs, "few-texts").collect()]
        assert spark.conf.get(key) == "10000"
    finally:
        spark.conf.set(key, before)
    assert sum(found) == 3000 and max(found) <= 500


def test_the_slow_tokenizer_is_loaded_only_for_texts_that_need_it(monkeypatch):
    import tokenizers

    plain, loaded = Tokenizer.from_file(vocabulary_path()), []

    class Counted:
        @staticmethod
        def from_file(path):
            loaded.append(path)
            return plain

    monkeypatch.setattr(tokenizers, "Tokenizer", Counted)
    encoder.cache_clear()
    try:
        encode = encoder(vocabulary_path())
        assert encode("plain text").tolist() == plain.encode("plain text", add_special_tokens=False).ids and not loaded
        monkeypatch.setattr("tiktoken.Encoding.encode_to_numpy", lambda *a, **k: (_ for _ in ()).throw(ValueError("refused")))
        for _ in range(2):
            assert encode("a text").tolist() == plain.encode("a text", add_special_tokens=False).ids
        assert len(loaded) == 1
    finally:
        encoder.cache_clear()


# token matrix


def plain_best_fit(lengths, width):
    """The same rule by looking at every open bin."""
    bins, free, used = [], [], []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        fits = [b for b in range(len(bins)) if free[b] >= lengths[i]]
        if fits:
            least = min(free[b] for b in fits)
            b = max((b for b in fits if free[b] == least), key=lambda b: used[b])
        else:
            b = len(bins)
            bins.append([])
            free.append(width)
            used.append(0)
        bins[b].append(i)
        free[b] -= lengths[i]
        used[b] = sum(map(len, bins))
    return bins


@pytest.mark.parametrize("width", [1, 7, 16, 100])
def test_best_fit_decreasing(width):
    rng = random.Random(width)
    for n in (0, 1, 5, 200):
        lengths = [rng.randint(1, width) for _ in range(n)]
        assert best_fit_decreasing(lengths, width) == plain_best_fit(lengths, width)


def test_token_matrix_is_a_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(matrices, "CHUNK", 5000)
    texts = edge_texts()
    docs = table(spark, texts).repartition(3)
    write_token_matrix(token_matrix(docs, vocabulary_path(), width=256), str(tmp_path / "m"))
    rows = read_token_matrix(spark, str(tmp_path / "m")).collect()
    encode, found = encoder(vocabulary_path()), {}
    assert len({r.sequence_id for r in rows}) == len(rows)
    for r in rows:
        ids = np.frombuffer(bytes(r.ids), "<u2")
        assert len(ids) == 256 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens and (ids[r.n_tokens:] == 0).all()
        assert r.position_resets == r.cu_seqlens[:-1] and r.ids_crc32 == zlib.crc32(bytes(r.ids))
        assert [i for i, p in enumerate(position_ids(r.cu_seqlens, 256)) if p == 0] == [x for x in r.cu_seqlens if x < 256]
        for doc_id, start, a, b in zip(r.doc_ids, r.starts, r.cu_seqlens, r.cu_seqlens[1:]):
            found.setdefault(doc_id, []).append((start, ids[a:b].tolist()))
    for i, text in enumerate(texts):
        pieces = sorted(found[i])
        assert [x for _, ids in pieces for x in ids] == [*encode(text or "").tolist(), 50256]
        assert [s for s, _ in pieces] == list(range(0, 256 * len(pieces), 256))
    assert token_matrix(docs.limit(0), vocabulary_path()).count() == 0
    with pytest.raises(ValueError):
        token_matrix(docs, vocabulary_path(), end_id=100_000)
