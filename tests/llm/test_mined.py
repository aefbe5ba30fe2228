"""Hard negatives, phrase collocations and main texts against brute force and on odd input."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from homelake.llm import negatives, phrases, templates

VECTORS = "vec_id long, embedding array<double>, label int, fragment string, `group` int"


# hard negatives


def brute_negatives(rows, every=100, positives=5, negatives=5, low=80, high=100, scale=256):
    usable = []
    for place, (vec_id, vector, label, *_) in enumerate(rows):
        if label is None or vector is None or any(x is None or not math.isfinite(x) or not math.isfinite(x * scale) for x in vector):
            continue
        usable.append((place, vec_id, [math.floor(scale * x) for x in vector], label))
    out = []
    clip = lambda s: max(-(1 << 63), min((1 << 63) - 1, s))
    for place, vec_id, own, label in usable:
        if vec_id is None or vec_id % every:
            continue
        found = [(clip(sum(x * y for x, y in zip(own, v))), i, other) for p, i, v, other in usable if p != place and len(v) == len(own)]
        found.sort(key=lambda f: (-f[0], f[1] is None, f[1] or 0))
        for score, positive, _ in [f for f in found if f[2] == label][:positives]:
            hard = [f for f in found if f[2] != label and low * score <= 100 * f[0] <= high * score][:negatives]
            out += [(vec_id, positive, n, f[1], score, f[0]) for n, f in enumerate(hard, 1)]
    return sorted(out, key=str)


def mined(spark, rows, **how):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], VECTORS)
    found = negatives.hard_negatives(df, **how)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, found.collect()), key=str)


def test_negatives_against_brute_force(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 24))
    rows = [(i, (centres[i % 6] + rng.normal(size=24) * 0.7).tolist(), int(rng.integers(0, 3))) for i in range(700)]
    want = brute_negatives(rows, every=10)
    assert len(want) > 300
    assert mined(spark, rows, every=10) == want
    assert mined(spark, rows, every=10, fragment=50) == want


def test_negatives_of_odd_rows(spark):
    rng = random.Random(4)
    vector = lambda n=8: [rng.uniform(-1, 1) for _ in range(n)]
    rows = [(i, vector(), i % 2) for i in range(60)]
    rows += [(None, vector(), 0), (None, vector(), 1), (500, None, 0), (600, vector(), None), (700, [1.0, None] + vector(6), 0)]
    rows += [(800, [math.nan] + vector(7), 0), (900, [math.inf] + vector(7), 1), (1000, vector(5), 0), (1001, vector(5), 1), (1100, [], 0), (1101, [], 1), (1102, [], 0)]
    # Vectors of all zeros tie with each other; whole scores far beyond 24 and 52 bits.
    rows += [(1200 + i, [0.0] * 8, i % 2) for i in range(4)]
    rows += [(1300 + i, [x * 3e7 for x in vector()], i % 2) for i in range(12)] + [(1400 + i, [x * 1e12 for x in vector()], i % 2) for i in range(6)]
    want = brute_negatives(rows, every=100)
    got = mined(spark, rows, every=100, fragment=16)
    assert got == want and any(r[0] == 1100 for r in got) and any(abs(r[4]) > 1 << 53 for r in got)


def test_negatives_of_repeated_ids_and_copies(spark):
    same = [0.5, 0.25, -0.125]
    rows = [(0, same, 1), (0, same, 1), (1, same, 0), (1, same, 0), (2, same, 1), (3, same, 0)]
    got = mined(spark, rows, every=100, negatives=2)
    score = 128 * 128 + 64 * 64 + 32 * 32
    # Each of the two anchors has the other and row 2 as positives.
    assert Counter(got) == Counter({(0, 0, 1, 1, score, score): 2, (0, 0, 2, 1, score, score): 2, (0, 2, 1, 1, score, score): 2, (0, 2, 2, 1, score, score): 2})


def test_negatives_of_no_rows(spark):
    assert mined(spark, []) == [] and mined(spark, [(1, [1.0], 0), (2, None, None)]) == [] and mined(spark, [(100, [1.0], 0)]) == []


def test_bounds_take_candidates_away_before_the_last_column():
    rng = np.random.default_rng(5)
    columns = np.floor(rng.normal(size=(64, 500)) * 10)
    columns[:, :3] += 100
    fragment = negatives.Fragment(
        0, 64, "f4", columns.astype("<f4").tobytes(), np.stack([np.arange(500), np.zeros(500)], 1).astype(np.int64).tobytes(),
        np.zeros(500, np.int64).tobytes(), np.zeros(500, bool).tobytes(),
    )
    left = []

    def narrowed(rows, low, high):
        keep = high >= negatives._kth(low, 2)
        exact = np.array([2.0] * 64) @ columns[:, rows]
        assert (low <= exact).all() and (exact <= high).all()
        left.append(int(keep.sum()))
        return keep

    rows, scores = fragment.scan(np.array([2.0] * 64), np.arange(500), narrowed)
    assert left[0] <= 500 and left[-2] < 250 and set(rows) <= {0, 1, 2}
    assert (scores == np.array([2.0] * 64) @ columns[:, rows]).all()


# phrases


def brute_phrases(docs, min_count, covered, top, longest=3):
    import re

    counts = defaultdict(Counter)
    for lang, text in docs:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            for n in range(1, longest + 1):
                counts[lang or "und" if lang is None else lang].update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, found in counts.items():
        n = sum(v for p, v in found.items() if len(p) == 1)
        candidates = {p: a for p, a in found.items() if len(p) > 1 and a >= min_count}
        rows = []
        for p, a in candidates.items():
            score, _, left, right = min((10**6 * a * a // (found[p[:k]] * found[p[k:]]), k, found[p[:k]], found[p[k:]]) for k in range(1, len(p)))
            inside = [f for q, f in candidates.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if not any(100 * f >= covered * a for f in inside):
                rows.append((-score, -a, " ".join(p).encode(), left, right))
        rows.sort()
        out += [(lang, i, p.decode(), -a, left, right, n, -s) for i, (s, a, p, left, right) in enumerate(rows[:top], 1)]
    return sorted(out)


def collocations(spark, docs, **how):
    df = spark.createDataFrame([(lang, text, 1, "x") for lang, text in docs], "lang string, text string, total int, phrase string")
    return sorted(map(tuple, phrases.collocations(df, **how).collect()))


def test_phrases_against_brute_force(spark):
    rng = random.Random(6)
    words = ["a", "B", "b", "ça", "Ça", "x-y", "zz", " ", "'s", "9"]
    docs = []
    for _ in range(400):
        parts = [rng.choice(words) + rng.choice(["", "", "", ".", ",", "\n", "\t", "!?"]) for _ in range(rng.randint(0, 40))]
        docs.append((rng.choice(["en", "en", "de", None, "und"]), rng.choice([" ", "  ", " \t"]).join(parts)))
    docs += [("en", None), (None, None), ("fr", ""), ("fr", " . \n"), *[("en", "one two three. one two three")] * 8, ("de", "w " * 5000)]
    for how in ({}, {"shard_words": 500, "bucket_bytes": 700}, {"shard_words": 3000, "bucket_bytes": 10**9}):
        for top in (2000, 7):
            got = collocations(spark, docs, min_count=10, covered=50, top=top, **how)
            assert got == brute_phrases(docs, 10, 50, top)


def test_longer_phrases(spark):
    rng = random.Random(7)
    docs = [("en", " ".join(rng.choice("abcd") for _ in range(60))) for _ in range(60)] + [("en", "p q r s t " * 30)]
    assert collocations(spark, docs, min_count=4, covered=60, top=500, longest=5, shard_words=400) == brute_phrases(docs, 4, 60, 500, 5)


def test_each_shard_is_mined_at_its_share_of_the_support():
    """What no shard finds frequent has less than the wanted count, however the texts are dealt."""
    rng = random.Random(8)
    texts = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 30))) for _ in range(300)]
    total = sum(len(t) for t in texts)
    overall = Counter()
    candidates = set()
    for at in range(0, 300, 60):
        shard = phrases.Shard()
        for text in texts[at : at + 60]:
            shard.add(text)
        support = 19 * shard.bytes // total + 1
        assert 1 < support <= 20
        local = Counter()
        for found, _, counts in shard.mined(3):
            local.update(dict(zip(found.to_pylist(), counts.tolist())))
        overall.update(local)
        candidates |= {p for p, n in local.items() if n >= support}
    frequent = {p for p, n in overall.items() if n >= 20}
    assert frequent <= candidates and len(candidates) < len(overall)


def test_phrases_of_large_counts_are_exact(spark):
    """Products beyond 64 bits."""
    a, l, r = 3_000_000_007, 5_000_000_029, 4_000_000_007
    counts = spark.createDataFrame([(a, l, r)], "a long, l long, r long")
    a_, l_, r_ = (F.col(c).cast("decimal(15,0)") for c in "alr")
    found = counts.select((F.lit(10**6).cast("decimal(7,0)") * (a_ * a_)).alias("top"), (l_ * r_).alias("bottom")).selectExpr("top div bottom as s")
    assert found.first().s == 10**6 * a * a // (l * r)


def test_phrases_of_no_rows(spark):
    assert collocations(spark, []) == [] and collocations(spark, [("en", None), (None, "")]) == []


# main texts


def text_of(html, template=()):
    return templates.Subtrees(html).text(set(template))


def test_main_text_of_marked_articles():
    page = (
        "<html><head><title>no</title><style>p{}</style></head><body class='no-sidebar'><header><h1>Site</h1></header><nav>n</nav>"
        "<main><article><header><h1> The&nbsp;\n title </h1></header><p>a<br>b <i>c</i>d<p>e &amp; &lt;f&gt;<script>x</script><div class='ad-slot'>ad</div>"
        "<aside>s</aside><form>q</form><blockquote>g</blockquote><table><tr><td>1<td>2</table><footer>by</footer></article>"
        "<article class=comment>no</article><section id=comments><p>no</section></main><footer>f</footer></body></html>"
    )
    assert text_of(page) == "The title\na b cd\ne & <f>\ng\n1\n2"


def test_main_text_of_unmarked_pages():
    page = (
        "<div id=top-menu>m</div><div class='content has-sidebar'><h1>T</h1><p>a<p hidden>h</p><div role=navigation>n</div>"
        "<div class=CookieBanner>c</div><div style='display: none'>d</div>tail</div><div class='side-bar'>s</div><div class=site-header>x</div>"
    )
    assert text_of(page) == "T\na\ntail"
    assert text_of("loose <b>x</b> text<div>b</div>") == "loose x text\nb"
    assert text_of(None) == text_of("") == text_of("<p> &nbsp; </p>") == ""
    assert text_of("<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"
    assert text_of("a&ampb &quot x &nosuch; &#x41;<p>&copy") == 'a&b " x &nosuch; A\n©'
    assert text_of('<div class="related page"><main><h1>t</h1><p>a</p></main></div>') == "t\na"


PAGES = "page_id long, url string, html string, host string, text string"


def extracted(spark, rows, **how):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], PAGES)
    found = templates.main_texts(df, **how)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    rows = found.collect()
    assert all(r.n_chars == len(r.text) for r in rows)
    return sorted((r.page_id, r.text) for r in rows)


def site(n, body="<div><p>{text}</p></div>"):
    """Pages with an unnamed menu that all share and a notice in each second one."""
    menu = "<div><ul><li>Home</li><li>News</li></ul></div>"
    notice = "<div><span>We changed our terms.</span></div>"
    rows = []
    for i in range(n):
        text = f"Text of page {i}."
        rows.append((i, f"http://A.example:80/{i}", f"<body>{menu}{notice if i % 2 else ''}{body.format(text=text)}</body>"))
    return rows, [(i, f"Text of page {i}.") for i in range(n)]


def test_subtrees_that_recur_on_a_host_go(spark):
    rows, texts = site(12)
    assert extracted(spark, rows) == texts
    # On three pages nothing recurs often enough; on another host nothing is known.
    kept = "Home\nNews\nText of page 0."
    assert extracted(spark, rows[:3])[0] == (0, kept)
    assert extracted(spark, [*rows, (99, "https://b.example/", rows[0][2])])[-1] == (99, kept)


def test_copies_of_a_page_are_one_page(spark):
    page = "<body><div><section>One article.</section></div></body>"
    rows = [(i, f"http://a.example/{i}", page) for i in range(20)]
    assert extracted(spark, rows) == [(i, "One article.") for i in range(20)]


def test_recurring_passages_of_articles_stay(spark):
    rows, texts = site(12, "<article><p>{text}</p><p>Quoted by all.</p><div><b>Sign up today</b></div></article>")
    assert extracted(spark, rows) == [(i, t + "\nQuoted by all.") for i, t in texts]


def test_a_large_host_and_odd_rows(spark):
    rows, texts = site(600)
    rows += [(None, None, None), (7, None, ""), (7, "no address", "<p>a</p>"), (7, "no address", "<p>a</p>"), (8, "//h", "<p>" + "long text " * 50_000)]
    got = extracted(spark, [r for r in rows if r[0] is not None])
    assert got[: len(texts) + 5] == sorted(texts + [(7, ""), (7, "a"), (7, "a"), (8, ("long text " * 50_000).strip())])
    df = spark.createDataFrame([(None, None, None, "x", "y")], PAGES)
    assert [tuple(r) for r in templates.main_texts(df).collect()] == [(None, None, "", 0)]


def test_no_pages(spark):
    assert extracted(spark, []) == []


def test_parameters_of_templates(spark):
    rows, _ = site(12)
    known = templates.site_templates(spark.createDataFrame(rows, "page_id long, url string, html string"), min_pages=7)
    assert [r.host for r in known.collect()] == ["a.example"]
    with_notice = extracted(spark, rows, min_pages=7)
    assert with_notice[1] == (1, "We changed our terms.\nText of page 1.") and with_notice[0] == (0, "Text of page 0.")


@pytest.mark.parametrize("name,gone", [("comment-list", True), ("entry-content", False), ("shadow", False), ("adSlot2", True), ("header", False), ("loading", False)])
def test_names_of_site_parts(name, gone):
    assert text_of(f"<div class='{name}'>x</div>y") == ("y" if gone else "x\ny")
