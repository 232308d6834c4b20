"""Periodic runs, repeated byte strings and the Merkle manifest on small tables with every edge."""

import hashlib
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import merkle
from sluice.llm.merkle import fold, merkle_manifest, proof_digest
from sluice.llm.periodic_runs import collapse_runs, lyndon_lengths, runs_of_texts
from sluice.llm.queries import QUERIES, planted_period
from sluice.llm.repeats import CHUNK, LIMIT, covers_of, maximal_repeats, pieces_of, remove_repeats

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, key string, runs int, grp int, at int, row int, extra string, "
        "leaf int, anchor int, removed int, kept int, n_words int, digest string")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def documents(spark, rows):
    """Rows of (doc_id, text, lang, source, n_chars) with columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, "k", 1, 2, 3, 4, "x", 5, 6, 7, 8, 9, "d") for r in rows], DOCS)


def texts_table(spark, texts):
    return documents(spark, [(i, t, "en", "s", 0) for i, t in enumerate(texts)])


# periodic runs


def brute_lyndon(s):
    def is_lyndon(w):
        return all(w < w[k:] for k in range(1, len(w)))

    return [max(j - i for j in range(i + 1, len(s) + 1) if is_lyndon(s[i:j])) for i in range(len(s))]


def brute_runs(words, min_length=6, exponent=4):
    number = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    out = []
    for q in range(1, len(words) // exponent + 1):
        edges = np.flatnonzero(np.diff(np.r_[0, (ids[q:] == ids[:-q]).astype(int), 0]))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
            size = b - a + q
            if size >= max(min_length, exponent * q) and not any((ids[a:a + size - p] == ids[a + p:a + size]).all() for p in range(1, q)):
                out.append((a, size, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def run_row(doc_id, text):
    words = planted_period(doc_id, [w.encode() for w in WORD.findall(text or "")])
    runs = brute_runs(words)
    dropped = {i for s, size, q in runs for i in range(s + q, s + size)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
    listed = "".join(f"{s},{size},{q}\n" for s, size, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, hashlib.sha256(listed.encode()).hexdigest(),
            hashlib.sha256(kept).hexdigest())


def periodic_texts(seed, n, longest):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        words = []
        while len(words) < rng.randint(1, longest):
            if rng.random() < 0.5:
                words += [rng.choice("abcdefghij") for _ in range(rng.randint(1, 6))]
            else:
                root = [rng.choice("abc" if rng.random() < 0.5 else "abcdefghijklmnop") for _ in range(rng.randint(1, rng.choice([6, 40])))]
                times = rng.randint(2, 7)
                words += (root * times)[:len(root) * times - rng.randint(0, len(root) - 1)]
        out.append([w.encode() for w in words])
    return out


def test_lyndon_lengths_equal_all_prefixes():
    rng = random.Random(3)
    for _ in range(800):
        s = [rng.randint(0, rng.randint(0, 3)) for _ in range(rng.randint(1, 14))]
        assert lyndon_lengths(s) == brute_lyndon(s)
    assert lyndon_lengths([]) == [] and lyndon_lengths([7] * 5000) == [1] * 5000


@pytest.mark.parametrize("min_length, exponent", [(6, 4), (1, 3), (20, 5)])
def test_runs_equal_all_periods(min_length, exponent):
    texts = periodic_texts(8, 300, 300)
    for i in range(0, len(texts), 6):
        part = texts[i:i + 6] + [[]]
        assert runs_of_texts(part, min_length, exponent) == [brute_runs(t, min_length, exponent) for t in part]


def test_long_periods_and_nested_runs():
    rng = random.Random(4)
    root = [str(rng.randrange(300)).encode() for _ in range(3000)]
    inner = [b"x", b"y"] * 4
    text = [b"head"] + (root + inner) * 5 + [b"tail"]
    found = runs_of_texts([text, root * 3], 6, 4)
    assert found[0] == brute_runs(text) and (1, 5 * 3008, 3008) in found[0] and len(found[0]) >= 6
    assert found[1] == []


def test_periodic_runs_query_on_edges(spark, tmp_path):
    texts = [None, "", " \t\n\x0b\x0c\r ", "one", "a " * 6, "a " * 5, "a b " * 8, "x y x y x y x y", " ".join("abcd" * 9), "\x1c \x1c " * 9,
             "word " * 3_000, *[b" ".join(t).decode() for t in periodic_texts(5, 60, 200)]]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts + texts[4:8])] + [(None, "b " * 9, None, None, None), (3, "one", "en", "s", 0)]
    path = tmp_path / "sf"
    documents(spark, rows).write.parquet(str(path / "documents.parquet"))
    got = [tuple(r) for r in QUERIES["op11_periodic_runs"](spark, str(path)).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256").collect()]
    assert sorted(got, key=str) == sorted((run_row(r[0], r[1]) for r in rows), key=str)


def test_collapsed_text_and_empty_table(spark):
    docs = texts_table(spark, ["go go go go go go now", "la di la di la di la di la end", None])
    rows = {r["doc_id"]: r for r in collapse_runs(docs).collect()}
    assert rows[0]["collapsed"] == "go now" and rows[1]["collapsed"] == "la di end" and rows[2]["collapsed"] == "" and rows[2]["n_words"] == 0
    assert [tuple(r) for r in rows[1]["runs"]] == [(0, 9, 2)]
    assert collapse_runs(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        collapse_runs(docs, exponent=2)


# repeated byte strings


def brute_removed(texts, length):
    raw = [(t or "").encode() for t in texts]
    times = Counter(t[i:i + length] for t in raw for i in range(len(t) - length + 1))
    out = []
    for t in raw:
        lost = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if times[t[i:i + length]] > 1:
                lost[i:i + length] = True
        edges = np.flatnonzero(np.diff(np.r_[0, lost.astype(int)]))
        out.append(([(int(a), int(b)) for a, b in zip(edges[::2], edges[1::2])], bytes(c for c, x in zip(t, lost) if not x)))
    return out


def repeated_texts(seed, n):
    rng = random.Random(seed)
    base = ["".join(rng.choice("ab" if rng.random() < 0.3 else "abcdefgh é\n") for _ in range(rng.randint(30, 200))) for _ in range(4)]
    texts = [None, "", "short", "a" * 300, "ab" * 100, "\x00" * 90]
    for _ in range(n):
        text = ""
        for _ in range(rng.randint(1, 4)):
            b = rng.choice(base)
            i = rng.randint(0, len(b))
            text += b[i:rng.randint(i, len(b))] + rng.choice(["", "x", "yz"])
        texts.append(text)
    return texts + texts[6:9] + texts[:4]


@pytest.mark.parametrize("length, limit, chunk", [(20, LIMIT, CHUNK), (20, 1, 500), (33, 3, 1)])
def test_removed_spans_equal_all_strings(spark, length, limit, chunk):
    """The second and third cases compare large groups by the hashes of their strings."""
    texts = repeated_texts(length, 60)
    rows = remove_repeats(texts_table(spark, texts), length=length, limit=limit, chunk=chunk).collect()
    got = {r["doc_id"]: ([tuple(s) for s in r["removed"]], bytes(r["kept"])) for r in rows}
    assert len(rows) == len(texts) and [got[i] for i in range(len(texts))] == brute_removed(texts, length)
    assert all(r["n_kept"] == len(r["kept"]) for r in rows)


def test_anchors_follow_from_the_string_alone():
    rng = random.Random(9)
    shared = bytes(rng.choice(b"abcdef") for _ in range(120))
    for _ in range(50):
        texts = [bytes(rng.choice(b"abcdef") for _ in range(rng.randint(0, 90))) for _ in range(4)]
        a, b = texts[0] + shared + texts[1], texts[2] + shared + texts[3]
        places = []
        for text, shift in ((a, len(texts[0])), (b, len(texts[2]))):
            anchor = {p: x for lo, hi, x in pieces_of(text, 40) for p in range(lo, hi + 1)}
            assert sorted(anchor) == list(range(len(text) - 39))
            places.append([anchor[shift + p] - shift for p in range(81)])
        assert places[0] == places[1]


def test_interval_tree_gives_the_deepest_maximal_repeat():
    rng = random.Random(2)
    for _ in range(12):
        length = 16
        body = bytes(rng.choice(b"abc") for _ in range(60))
        strings = list(dict.fromkeys(body[rng.randint(0, 20):rng.randint(36, 60)] + bytes([rng.choice(b"abc")]) * rng.randint(0, 2) for _ in range(5)))

        def occurrences(u):
            return [(k, i) for k, s in enumerate(strings) for i in range(len(s) - len(u) + 1) if s[i:i + len(u)] == u]

        def maximal(u):
            found = occurrences(u)
            lefts = {strings[k][i - 1] if i else (k, i) for k, i in found}
            rights = {strings[k][i + len(u)] if i + len(u) < len(strings[k]) else (k, i) for k, i in found}
            return len(found) > 1 and len(lefts) > 1 and len(rights) > 1

        expected = set()
        for k, s in enumerate(strings):
            for i in range(len(s) - length + 1):
                ends = [e for e in range(i + length, len(s) + 1) if maximal(s[i:e])]
                if ends:
                    expected.add((k, i, ends[-1], ends[-2] - i if len(ends) > 1 else None))
        rows = covers_of(strings, length)
        names = {name: strings[s][a:e] for s, a, e, name, _ in rows}
        assert {(s, a, e, len(names[around]) if around in names else None) for s, a, e, _, around in rows} \
            == {(s, a, e, d if d and any(len(names[n]) == d and strings[s][a:a + d] == names[n] for n in names) else None) for s, a, e, d in expected}


def test_repeat_groups_list_all_occurrences(spark):
    shared = "the same passage in many texts, again and again "
    texts = [f"{i} begins {shared}and ends {i * 7}" for i in range(30)] + ["nothing of it"]
    rows = maximal_repeats(texts_table(spark, texts), length=40).collect()
    held = Counter(r["repeat"] for r in rows)
    assert max(held.values()) >= 30 and {r["doc_id"] for r in rows} == set(range(30))
    strings = {}
    for r in rows:  # one string per group
        part = texts[r["doc_id"]].encode()[r["start"]:r["start"] + r["size"]]
        assert strings.setdefault(r["repeat"], part) == part


def test_no_rows_and_no_repeats(spark):
    docs = texts_table(spark, ["a text that is long enough to be looked at", None])
    assert remove_repeats(docs.limit(0), length=20).collect() == []
    rows = remove_repeats(docs, length=20).orderBy("doc_id").collect()
    assert [(r["removed"], bytes(r["kept"])) for r in rows] == [([], b"a text that is long enough to be looked at"), ([], b"")]
    with pytest.raises(ValueError):
        remove_repeats(docs, length=15)


# merkle manifest


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def manifest_rows(rows):
    def leaf(r):
        return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r[0], r[3], r[2], r[4], r[1])))

    def tree(level):
        out = [level]
        while len(out[-1]) > 1:
            out.append([digest(*out[-1][i:i + 2]) for i in range(0, len(out[-1]), 2)])
        return out

    def siblings(levels, i):
        out = []
        for level in levels[:-1]:
            out.append((i % 2 == 1, level[i ^ 1] if i ^ 1 < len(level) else None))
            i //= 2
        return out

    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda lang: (lang is not None, (lang or "").encode()))
    groups = {n: sorted(groups[n], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for n in names}
    trees = {n: tree([leaf(r) for r in groups[n]]) for n in names}
    crown = tree([trees[n][-1][0] for n in names]) if names else []
    out = []
    for k, n in enumerate(names):
        for i, r in enumerate(groups[n]):
            proof = siblings(trees[n], i) + siblings(crown, k)
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[4] is not None
            node = leaf((*r[:4], r[4] + 1)) if changed else leaf(r)
            for left, other in proof:
                node = digest(node) if other is None else digest(other, node) if left else digest(node, other)
            out.append((r[0], leaf(r), trees[n][-1][0], crown[-1][0], digest(*(s for _, s in proof if s)), node, node == crown[-1][0]))
    return sorted(out, key=str)


def edge_rows(n, langs, seed=1):
    rng = random.Random(seed)
    rows = [(rng.choice([None, rng.randrange(-50, 10**12)]) if rng.random() < 0.1 else i, rng.choice([None, "", "é\U0001f600", "text " * rng.randrange(50)]),
             rng.choice(langs), rng.choice([None, "", "src1"]), rng.choice([None, 0, 12, 2**63 - 1])) for i in range(n)]
    return rows + rows[:3]


@pytest.mark.parametrize("rows, width", [
    (edge_rows(300, [None, "", "en", "en", "en", "zz", "é"]), 2), (edge_rows(70, ["en"]), 1), (edge_rows(257, ["en", "de"]), 10), ([(1, "a", "en", "s", 1)], 3),
    (edge_rows(40, [f"l{i}" for i in range(30)]), 2), ([], 3),
])
def test_manifest_query_equals_a_plain_tree(spark, tmp_path, monkeypatch, rows, width):
    monkeypatch.setattr(merkle, "BAND", width)
    monkeypatch.setattr(merkle.grow, "__defaults__", (width,))
    monkeypatch.setattr(merkle.descend, "__defaults__", (width,))
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op13_merkle_manifest"](spark, str(tmp_path)).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()
    assert sorted(map(tuple, got), key=str) == manifest_rows(rows)


def test_proofs_lead_to_the_root_and_show_a_change(spark):
    docs = documents(spark, [(i, f"text {i}", "en" if i % 3 else "de", "s", i) for i in range(50)])
    proofs = merkle_manifest(docs)
    right = proofs.select((fold(F.col("leaf"), F.col("proof")) == F.col("root")).alias("same"), proof_digest(F.col("proof")).alias("d"), "rank", "subroot")
    rows = right.collect()
    assert all(r["same"] for r in rows) and len({r["d"] for r in rows}) == 50 and len({r["subroot"] for r in rows}) == 2
    assert sorted(r["rank"] for r in rows) == sorted([*range(17), *range(33)])
    other = proofs.select((fold(F.sha2(F.col("leaf").cast("binary"), 256), F.col("proof")) == F.col("root")).alias("same")).collect()
    assert not any(r["same"] for r in other)
