"""Near-duplicates, vectors, page text, the rule ensemble and the whole pipeline."""

import random
from collections import Counter

import brute
import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from sluice.llm import cross_polytope, shingles
from sluice.llm.components import connected
from sluice.llm.cross_polytope import hash_codes, link_vectors
from sluice.llm.html_text import extract_main_text, main_text
from sluice.llm.near_duplicates import find_groups, keep_one_per_group
from sluice.llm.rule_ensemble import fit_rules, score_quality

DOCS = "doc_id long, text string, lang string, source string, n_chars long, c long, n int, s string"


def documents(spark, texts, ids=None):
    rows = [(ids[i] if ids else i, t, "en", f"s{i % 3}", len(t or ""), 1, 2, "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def corpus(seed=3, n=60):
    """Texts, exact copies, near copies around the threshold, chains and a passage that many share."""
    rng = random.Random(seed)
    word = lambda: "w" + str(rng.randrange(5000))
    passage = [word() for _ in range(60)]
    texts = [None, "", "  \n", "one two", "One TWO", "one two three four", "a b c d e", "A b c d E", "a b c d e f"]
    for _ in range(n):
        words = [word() for _ in range(rng.randint(20, 120))]
        if rng.random() < 0.4:
            words += passage
        texts.append(" ".join(words))
        for _ in range(rng.choice([0, 0, 1, 3, 6])):
            copy = list(words)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy).upper() if rng.random() < 0.2 else " ".join(copy))
    hub = [word() for _ in range(100)]
    for _ in range(80):  # a large group whose members are far from one another, but near the hub
        copy = list(hub)
        for _ in range(2):
            copy[rng.randrange(100)] = word()
        texts.append(" ".join(copy))
    return texts + texts[20:30]


def groups(texts):
    """Brute force: every pair, then components by the smallest number."""
    sets = [brute.shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [(len(s), find(i)) for i, s in enumerate(sets)]


def test_shingles_match_brute_force():
    texts = corpus() + ["é x y", "tab\tand\x0bvt\x0cff\rcr", "x" * 5000 + " y z", "A" * 3 + " " * 2000 + "b"]
    for size in (1 << 20, 997):
        old, shingles.SEGMENT = shingles.SEGMENT, size
        try:
            got = shingles.shingle_sets(pa.array(texts))
            sliced = [s for i in range(0, len(texts), 7) for s in shingles.shingle_sets(pa.array(texts).slice(i, 7))]
        finally:
            shingles.SEGMENT = old
        seen = {}
        for own, text, again in zip(got, texts, sliced):
            want = brute.shingles(text)
            assert len(own) == len(want) and (np.diff(own.astype(object)) > 0).all() and (own == again).all()
            seen.setdefault(frozenset(want), own.tolist())
            assert seen[frozenset(want)] == own.tolist()
        assert len({tuple(v) for v in seen.values()}) == len(seen)


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (102, 101), (7, 3), (50, 50)]
    got = dict((r.node, r.root) for r in connected(spark.createDataFrame(chain, "a long, b long"), "t").collect())
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


def test_jaccard_join_matches_brute_force(spark):
    texts = corpus()
    got = {r.doc_id: (r.n, r.component_id) for r in find_groups(documents(spark, texts).select("doc_id", "text")).collect()}
    assert [got[i] for i in range(len(texts))] == groups(texts)


def test_jaccard_join_at_the_threshold(spark):
    """Sets of 8 of 10 link, of 79 of 100 do not."""
    words = [f"v{i}" for i in range(400)]
    pairs = []
    for cut in range(1, 40):
        base = words[:104]
        pairs += [" ".join(base), " ".join(base[:104 - cut])]
    got = {r.doc_id: r.component_id for r in find_groups(documents(spark, pairs).select("doc_id", "text")).collect()}
    assert [got[i] for i in range(len(pairs))] == [c for _, c in groups(pairs)]


def test_repeated_and_null_ids(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = documents(spark, [text, text, text, "x y z", "", None], ids=[None, 7, 7, None, 5, None])
    got = sorted(((r.doc_id, r.n, r.component_id) for r in find_groups(docs.select("doc_id", "text")).collect()), key=str)
    assert got == sorted([(None, 26, 7), (7, 26, 7), (7, 26, 7), (None, 1, None), (5, 0, 5), (None, 0, None)], key=str)
    kept = keep_one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(7, text), (None, "x y z"), (5, ""), (None, None)], key=str)
    assert keep_one_per_group(docs.limit(0)).count() == 0 and find_groups(docs.limit(0).select("doc_id", "text")).count() == 0


def test_one_document_of_each_group_stays(spark):
    texts = corpus(seed=9, n=25)
    want = groups(texts)
    kept = sorted(r.doc_id for r in keep_one_per_group(documents(spark, texts)).collect())
    assert kept == [i for i, (n, c) in enumerate(want) if not n or c == i]


# vectors


def test_vectors_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(cross_polytope, "BLOCK", 16)
    rng = np.random.default_rng(0)
    x = rng.normal(size=(150, 20))
    near = x[:60] + rng.normal(size=(60, 20)) * 0.08 * np.linalg.norm(x[:60], axis=1, keepdims=True) / np.sqrt(20) * 2
    hot = x[:1] * rng.uniform(0.5, 2, (70, 1)) + rng.normal(size=(70, 20)) * 0.05
    rows = np.concatenate([x, near, hot, x[:5], np.repeat(x[9:10], 40, axis=0)]).astype(np.float32)
    bad = [None, [0.0] * 20, [float("nan")] * 20, [1.0] * 19, [], [float("inf")] + [1.0] * 19, [None] + [1.0] * 19]
    data = [(i, [float(v) for v in r], i, 0) for i, r in enumerate(rows)] + [(1000 + i, v, 0, 0) for i, v in enumerate(bad)]
    got = {r.vec_id: r for r in link_vectors(spark.createDataFrame(data, "vec_id long, embedding array<float>, n int, cid int")).collect()}
    unit = rows.astype(float) / np.linalg.norm(rows.astype(float), axis=1, keepdims=True)
    links = unit @ unit.T >= 0.9
    np.fill_diagonal(links, False)
    root = np.arange(len(rows))
    for _ in range(len(rows)):
        low = np.array([min([root[i], *root[links[i]]]) for i in range(len(rows))])
        if (low == root).all():
            break
        root = low
    found = sum(got[i].n_links for i in range(len(rows)))
    assert found <= links.sum() and found >= 0.97 * links.sum()
    right = sum(got[i].component_id == root[i] for i in range(len(rows)))
    assert right >= 0.97 * len(rows)
    assert all(got[i].kept == (got[i].component_id == i) for i in range(len(rows)))
    for i in range(len(bad)):
        assert (got[1000 + i].n_links, got[1000 + i].component_id, got[1000 + i].kept) == (0, 1000 + i, True)


def test_recall_at_the_threshold():
    """Pairs with a cosine of exactly 0.9 in 64 dimensions."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1500, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.normal(size=(1500, 64))
    z -= (z * x).sum(axis=1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    a, b = (hash_codes(v, cross_polytope.TABLES, cross_polytope.HASHES, cross_polytope.PROBES) for v in (x, 0.9 * x + np.sqrt(0.19) * z))
    met = (a == b[:, :, :1]).any(axis=2) | (b == a[:, :, :1]).any(axis=2)
    assert met.any(axis=1).mean() >= 0.98


def test_vectors_null_ids_and_empty_table(spark):
    rows = spark.createDataFrame([(None, [1.0, 0.0]), (None, [1.0, 0.0]), (3, [1.0, 0.01]), (None, [0.0, 1.0])], "vec_id long, embedding array<double>")
    got = sorted(map(tuple, link_vectors(rows).collect()), key=str)
    assert got == sorted([(None, 2, 3, False), (None, 2, 3, False), (3, 2, 3, True), (None, 0, None, False)], key=str)
    assert link_vectors(rows.limit(0)).count() == 0


# page text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href=x>Home</a></li></ul></nav>
<div class="ad">Buy now</div><div id="cookie-notice" class="cookie">We use cookies</div><main><article><h1>Title &amp; more</h1>
<p>First <b>bold
 text</b> here.<p>Second&nbsp;one &lt;x&gt; <!-- no --> <a href="y">link</a>.<ul><li>item one<li>item two</ul>
<form><input><button>Send</button></form><script>var t="</p>";</script><table><tr><td>c1<td>c2</table></article></main>
<section class="comments"><p>A reader wrote a long comment that is dense in text and has no links at all, nothing.</p></section>
<aside>More</aside><footer>&copy; site</footer></body></html>"""


def test_page_text():
    assert main_text(PAGE) == "Title & more\n\nFirst bold text here.\n\nSecond one <x> link.\n\nitem one\n\nitem two\n\nc1\n\nc2"
    body = "word " * 60
    plain = f"<body><div><a href=1>menu a</a> <a href=2>menu b</a></div><div><div><p>{body}</p><p>{body}</p></div></div><div><a>x</a></div>"
    assert main_text(plain) == f"{body.strip()}\n\n{body.strip()}"
    assert main_text(None) == main_text("") == main_text("<html></html>") == ""
    assert main_text("just text & more <b>x") == "just text & more x"


def test_article_without_article_or_main_element_is_whole():
    title, para, menu = "A title of some fifty characters, or nearly so many", "Some words of text. " * 15, "<div><a>Home</a><a>About us</a></div>"
    paras = [f"{n} {para}".strip() for n in range(6)]
    body = "".join(f"<p>{p}</p>" for p in paras)
    page = f"<body>{menu}<div><h1>{title}</h1><div>{body}</div></div>{menu}</body>"
    assert main_text(page) == "\n\n".join([title, *paras])
    page = f"<div><div><h1>{title}</h1></div>Bare <b>lead</b> text<div>{body}<h2>Part</h2>bare<p>Short.</p></div><p>The end.</p>{menu}</div>"
    assert main_text(page) == "\n\n".join([title, "Bare lead text", *paras, "Part", "bare", "Short.", "The end."])
    page = f"<body><a>Home</a> <a>About us</a><h1>{title}</h1><div>{body}</div><div><div>{body}</div><h2>Part</h2></div></body>"
    assert main_text(page).endswith("\n\n".join([title, *paras, *paras, "Part"]))


@pytest.mark.parametrize("page", ["<", "<a", "<p class='x", "a < b > c", "<!--", "<!-- x", "<script>", "</p></div>", "<p>" * 5000, "<div>" * 20_000 + "x",
                                  "&#x110000;&am &amp", "<p a=\"'>'\">x</p>", "<![CDATA[x]]>", "\x00<p>\x00"])
def test_broken_pages(page):
    assert isinstance(main_text(page), str)


def test_page_query_keeps_rows(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, "t"), (1, "u", PAGE, "t"), (None, None, None, "t"), (3, "v", "", None)],
                                  "page_id long, url string, html string, text string")
    rows = extract_main_text(pages).collect()
    assert sorted(len(r.text) for r in rows) == [0, 0, len(main_text(PAGE)), len(main_text(PAGE))]
    assert extract_main_text(pages.limit(0)).count() == 0


# rule ensemble


def test_rules_find_a_conjunction():
    rng = np.random.default_rng(5)
    x = rng.uniform(size=(3000, 4))
    y = ((x[:, 0] > 0.4) & (x[:, 2] <= 0.7)).astype(float)
    model = fit_rules(x, y, list("abcd"))
    logit = np.full(len(x), model.bias)
    for rule, weight in model.rules:
        logit += weight * np.logical_and.reduce([(x[:, f] > c) == above for f, above, c in rule])
    assert ((logit > 0) == y).mean() > 0.98 and 0 < len(model.rules) < 120
    assert fit_rules(x[:0], y[:0], list("abcd")).rules == [] and fit_rules(x, y * 0, list("abcd")).bias < -5


def test_quality_scores(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("aeioulmnrst") for _ in range(rng.randint(2, 8)))
    good = [" ".join(word() for _ in range(60)) for _ in range(300)]
    bad = [" ".join(word() + "##" for _ in range(60)) for _ in range(300)]
    texts = [None, "", *good, *bad]
    labels = spark.createDataFrame([(i + 2, 1, 0) for i in range(300)] + [(i + 302, 0, None) for i in range(300)] + [(9999, None, None), (None, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    scored, model = score_quality(documents(spark, texts), labels)
    rows = {r.doc_id: r for r in scored.collect()}
    assert len(rows) == len(texts) and model.rules
    import zlib
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 for i, r in rows.items())
    assert all(rows[i].score > 0.5 for i in range(2, 302)) and all(rows[i].score < 0.5 for i in range(302, 602))
    assert score_quality(documents(spark, ["x"]).limit(0), labels)[0].count() == 0


# pipeline


def test_pipeline_stages(spark, tmp_path):
    """Each stage against its brute-force counterpart, on what the stage before it kept."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("aeioulmnrst") for _ in range(rng.randint(2, 8)))
    prose = [" ".join(word() for _ in range(rng.randint(30, 90))).capitalize() + "." for _ in range(40)]
    texts = [*prose, *prose[:6], prose[7] + " extra", "mail me at a.b@c.de " + prose[3] + " from 10.1.2.3", "short", None,
             *[" ".join(word() + "$$$" for _ in range(50)) for _ in range(5)]]
    docs = documents(spark, texts).select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "near duplicates", "personal data", "source mix", "packing"]
    stages = dict(corpus_pipeline.STAGES)

    def after(stage, rows):
        """What a stage returns, written and read again as the next one gets it."""
        stages[stage](spark, rows, "").write.parquet(str(tmp_path / stage))
        return spark.read.parquet(str(tmp_path / stage))

    first = after("quality rules", docs)
    assert first.columns == docs.columns and {r.doc_id for r in first.collect()} == set(range(48))
    second = after("near duplicates", first)
    want = groups([texts[i] for i in range(48)])
    assert sorted(r.doc_id for r in second.collect()) == [i for i, (_, c) in enumerate(want) if c == i]
    third = after("personal data", second)
    assert third.columns == docs.columns and not [r for r in third.collect() if brute.base_spans(r.text)]
    fourth = after("source mix", third)
    assert fourth.columns == docs.columns and max(Counter(r.doc_id for r in fourth.collect()).values()) <= 3
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    taken = Counter(r.doc_id for r in fourth.collect())
    starts = Counter(r.doc_id for r in out if r.start == 0)
    assert starts == taken
