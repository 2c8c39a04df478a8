"""Near duplicates, repeated strings, neighbours and main texts against brute force."""

import hashlib
import math
import random
import re
import time

import numpy as np
import pytest

from terrazzo.llm import main_text, neighbours, ngram_join, repeats


def word_sets(text, width=3):
    words = text.encode().lower().split() if text else []
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def brute_components(rows, width=3, percent=90):
    sets = {}
    for i, t in rows:
        sets.setdefault(i, []).append(word_sets(t, width))
    ids = sorted(i for i in sets if i is not None)
    parent = {i: i for i in ids}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for k, a in enumerate(ids):
        for b in ids[:k]:
            if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def corpus(seed=1):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdefghij", k=4)) for _ in range(400)]
    rows, i = [], 0
    for size in (1, 2, 3, 5, 9, 11, 12, 21, 24, 33, 60, 130, 300):
        for _ in range(3):
            base = rng.choices(vocabulary, k=size)
            rows.append((i, " ".join(base)))
            i += 1
            for _ in range(6):
                copy = list(base)
                for _ in range(rng.randint(0, max(1, size // 40))):
                    copy[rng.randrange(size)] = rng.choice(vocabulary)
                rows.append((i, " ".join(copy).upper() if rng.random() < 0.2 else "\n".join(copy)))
                i += 1
    passage = " ".join(rng.choices(vocabulary, k=30))
    for _ in range(12):
        rows.append((i, passage + " " + " ".join(rng.choices(vocabulary, k=25))))
        i += 1
    return [*rows, (i, None), (i + 1, ""), (i + 2, " \n"), (0, rows[0][1])]


@pytest.mark.parametrize("width,percent,boundary,deal", [(3, 90, None, 1024), (3, 90, 24, 1), (5, 80, None, 2)])
def test_components_match_brute_force(spark, monkeypatch, width, percent, boundary, deal):
    monkeypatch.setattr(ngram_join, "DEAL", deal)
    if boundary:
        monkeypatch.setattr(ngram_join, "cheapest_boundary", lambda *_: boundary)
    rows = corpus()
    docs = spark.createDataFrame([(i, t, 1, "x", 2, 3) for i, t in [*rows, (None, "a null id")]], "doc_id long, text string, n int, component string, node int, sig int")
    got = ngram_join.join_components(docs, width=width, percent=percent).collect()
    want = brute_components(rows, width, percent)
    assert len(got) == docs.count()
    for r in got:
        assert r.component_id == want.get(r.doc_id), r
    sizes = {r.doc_id: r.n_shingles for r in got}
    assert all(sizes[i] == len(word_sets(t, width)) for i, t in rows)


def test_a_large_group_of_near_copies_hardly_reaches_the_exact_round(spark, monkeypatch):
    rng = random.Random(5)
    base, rows = [f"w{k}" for k in range(150)], []
    for i in range(240):
        copy = list(base)
        for place in rng.sample(range(150), 1 + i % 4):
            copy[place] = f"own{i}x{place}"
        rows.append((i, " ".join(copy)))
    met, rest = [], ngram_join.rest

    def counted(*args):
        pairs = rest(*args)
        met.append(pairs.count())
        return pairs

    monkeypatch.setattr(ngram_join, "rest", counted)
    monkeypatch.setattr(ngram_join, "cheapest_boundary", lambda *_: 1)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in ngram_join.join_components(docs, width=5, percent=80).collect()}
    assert got == brute_components(rows, 5, 80)
    assert 1 < len(set(got.values())) < len(rows) // 2
    assert len(met) == 1 and met[0] < len(rows), met


def test_both_halves_find_links_and_costs_choose_between(spark):
    rng = random.Random(3)
    words = [f"w{k}" for k in range(5000)]
    short, long = [], []
    for _ in range(150):
        base = rng.choices(words, k=9)
        short += [base, [*base, rng.choice(words)]]
    for _ in range(10):
        base = rng.choices(words, k=200)
        long += [base, [*base[:100], "new", *base[101:]]]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(short + long)], "doc_id long, text string")
    how = ngram_join.plan(docs, "doc_id", "text", 5, 80)
    assert 5 < how.boundary < 100
    nodes = ngram_join.describe(docs, "doc_id", "text", 5, 80, how).withColumnRenamed("key", "node")
    light = ngram_join.light_links(nodes).collect()
    assert len(light) == 150 and all(max(r) < 300 for r in light)
    got = {r.doc_id: r.component_id for r in ngram_join.join_components(docs, width=5, percent=80).collect()}
    assert all(got[i] == i - i % 2 for i in range(len(short + long)))
    # met: how many others an entry of a list meets
    sizes = {s: 100 for s in range(5, 60)}
    assert ngram_join.cheapest_boundary(sizes, 0.0, 80) < ngram_join.cheapest_boundary(sizes, 0.5, 80)


def test_counts_cover_all_documents(spark):
    docs = spark.createDataFrame([(i, "the same five words here " + f"x{i} y{i}") for i in range(40)], "doc_id long, text string").repartition(7)
    counts, sizes = ngram_join.corpus_counts(docs, "text", 5)
    assert sizes == {3: 40} and counts.sum() == 120 and counts.max() >= 40


def test_larger_sketches_bound_differences():
    rng = np.random.default_rng(2)
    for size in (900, 1100, 5000, 20000):
        a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        b = np.unique(np.concatenate([a[: int(size * 0.95)], rng.integers(0, 2**63, 30).astype(np.uint64)]))
        far = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        (ca, fa), (cb, fb), (_, ff) = map(ngram_join.sketch_of, (a, b, far))
        bits = lambda x, y: int(np.bitwise_count((x ^ y).view(np.uint64)).sum())
        apart = len(np.setxor1d(a, b))
        assert bits(ca, cb) <= apart
        if fa is not None and fb is not None and len(fa) == len(fb):
            assert bits(fa, fb) <= apart and bits(fa, ff) > 0.3 * size


def test_an_id_with_three_texts_links_by_each(spark):
    rng = random.Random(9)
    one, two, own = (" ".join(f"w{rng.randrange(10**6)}" for _ in range(30)) for _ in range(3))
    rows = [(2, one), (3, two), (5, one), (5, two), (5, own), (7, own), (8, "apart from all of them")]
    got = ngram_join.join_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = brute_components(rows)
    assert {r.doc_id: r.component_id for r in got} == want == {2: 2, 3: 2, 5: 2, 7: 2, 8: 8}


def test_empty_table_joins_nothing(spark):
    assert ngram_join.join_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_subsets_meet_exactly_where_sets_link():
    rng = np.random.default_rng(0)
    for _ in range(200):
        s = int(rng.integers(1, 24))
        a = np.unique(rng.integers(0, 2**63, s).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) > 0.07], rng.integers(0, 2**63, int(rng.integers(0, 3))).astype(np.uint64)]))
        if not len(b):
            continue
        both, either = len(np.intersect1d(a, b)), len(np.union1d(a, b))
        meet = set(map(tuple, ngram_join.subset_keys(a, 40, 90)[0].tolist())) & set(map(tuple, ngram_join.subset_keys(b, 40, 90)[0].tolist()))
        if len(a) != len(b) or 100 * both >= 90 * either:
            assert bool(meet) == (100 * both >= 90 * either) or len(a) != len(b)
        if 100 * both >= 90 * either:
            assert meet


def brute_repeats(rows, length=100):
    seen, out = set(), {}
    for i, data in rows:
        flags = np.zeros(len(data), bool)
        for k in range(len(data) - length + 1):
            w = data[k : k + length]
            if w in seen:
                flags[k : k + length] = True
            seen.add(w)
        edges = np.diff(np.concatenate([[0], flags.astype(int), [0]]))
        out[i] = (len(data), int(flags.sum()), int((edges == 1).sum()), hashlib.sha256(bytes(b for b, f in zip(data, flags, strict=True) if not f)).hexdigest())
    return out


@pytest.mark.parametrize("largest", [20_000, 2])
def test_repeats_match_brute_force(spark, monkeypatch, largest):
    monkeypatch.setattr(repeats, "LARGEST", largest)
    rng = random.Random(4)
    piece = lambda n: "".join(rng.choices("abcdefghijklmnop é", k=n))
    shared, other = piece(180), piece(140)
    texts = [piece(300) + shared + piece(50), shared, piece(99), shared[:120] + piece(200), other + other, "a" * 700, "ab" * 300, None, "", piece(20) + other[10:130] + shared[5:150], shared + shared, piece(3000), "a" * 150]
    texts += [piece(30) + shared + piece(30) for _ in range(8)] + [texts[0], "short", "short"]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in enumerate(texts)], "doc_id long, text string, size int, first int")
    got = {r[0]: tuple(r)[1:] for r in repeats.remove_repeats(docs).collect()}
    assert got == brute_repeats([(i, (t or "").encode()) for i, t in enumerate(texts)])
    full = repeats.remove_repeats(docs, texts=True).filter("doc_id = 4").first()
    assert bytes(full.kept) == other.encode() and [(s.a, s.b) for s in full.spans] == [(len(other.encode()), 2 * len(other.encode()))]


def test_longest_previous_factors_match_brute_force():
    rng = random.Random(1)
    for _ in range(40):
        length = rng.choice((9, 16, 20, 33, 100))
        segments = [bytes(rng.choices(b"ab", k=rng.randint(length, 4 * length)))]
        for _ in range(rng.randint(0, 4)):
            segments.append(bytes(rng.choices(b"abc", k=rng.randint(length, 3 * length))) if rng.random() < 0.5 else (segments[0] * 3)[5 : 5 + rng.randint(length, 2 * length)])
        data = b"".join(segments)
        ends = np.cumsum([len(x) for x in segments])
        starts = np.concatenate([np.arange(e - len(x), e - length + 1) for x, e in zip(segments, ends, strict=True)])
        got = repeats.longest_previous(np.frombuffer(data, np.uint8), starts, length)
        for i, p in enumerate(starts):
            shared = lambda q, p=p: next((k for k in range(length) if data[p + k] != data[q + k]), length)
            assert got[i] == max(map(shared, starts[:i]), default=0)


def test_repeats_across_chunks_and_batches(spark, monkeypatch):
    monkeypatch.setattr(repeats, "BATCH_BYTES", 2000)
    rng = random.Random(11)
    long = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz    ", k=repeats.CHUNK + 70_000))
    seam = repeats.CHUNK
    texts = ["x" + long[seam - 5000 : seam + 5000], long, "y" + long[-900:] + "z" + long[seam - 150 : seam + 150]]
    changed = list(long[:30_000])
    for k in range(0, len(changed), 170):
        changed[k] = "#"
    texts.append("".join(changed))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r[0]: tuple(r)[1:] for r in repeats.remove_repeats(docs).collect()}
    assert got == brute_repeats([(i, t.encode()) for i, t in enumerate(texts)])


def test_repeats_of_ids_nulls_and_nothing(spark):
    text = "x y z " * 40
    rows = [(None, text), (1, text), (1, text), (2, "q" * 99)]
    got = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    gone = {}
    for r in got:
        gone.setdefault(r.doc_id, set()).add(r.n_removed)
    assert gone[1] == {240} and gone[2] == {0} and max(gone[None]) < 240
    assert repeats.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_neighbours_rank_exactly_and_recall(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((1500, 16)).astype(np.float32) * rng.uniform(0.5, 2, (1500, 1)).astype(np.float32)
    x[100:160] = x[100]
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    odd = [(2000, None, 1), (2020, [0.0] * 16, 1), (2040, [float("nan")] * 16, 1), (2060, [float("inf")] + [1.0] * 15, 1), (2080, [1.0, None] + [1.0] * 14, 1), (2100, [1.0] * 3, 1), (None, x[0].tolist(), 1)]
    df = spark.createDataFrame([*rows, *odd], "vec_id long, embedding array<float>, rep int")
    got = neighbours.search(df).toPandas()
    assert set(got.query_id) == set(range(0, 1500, 20))
    wide, hits = x.astype(np.float64), []
    for q, g in got.groupby("query_id"):
        g = g.sort_values("rank")
        scores = np.array([(wide[i] * wide[q]).sum() for i in range(1500)])
        assert list(g["rank"]) == list(range(1, 21)) and q not in set(g.vec_id)
        assert np.allclose(g.score, scores[g.vec_id], rtol=1e-12)
        keys = list(zip(-g.score.round(12), g.vec_id, strict=True))
        assert keys == sorted(keys)
        scores[q] = -np.inf
        best = np.lexsort((np.arange(1500), -scores.round(10)))[:20]
        hits.append(len(set(best) & set(g.vec_id)) / 20)
    assert np.mean(hits) >= 0.9


def test_ties_go_to_smaller_ids(spark):
    rows = [(0, [1.0, 0.0])] + [(i, [0.5, 1e-6 * ((7 * i) % 400)]) for i in range(1, 400)]
    got = neighbours.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).filter("query_id = 0").orderBy("rank").collect()
    assert [r.vec_id for r in got] == list(range(1, 21)) and all(r.score == 0.5 for r in got)


def test_probes_come_in_order_of_success_and_hold_the_share():
    rng = np.random.default_rng(1)
    index = neighbours.Index(rng.standard_normal((2, 9, 6)), rng.random((2, 6)) * neighbours.WIDTH, 1.0, 0.9, 1)
    need = 1 - (1 - neighbours.RECALL) ** (1 / neighbours.TABLES)
    for table in (0, 1):
        place = rng.uniform(-3, 3, 6)
        found = index.probes(place, table)
        score = index.log_share(place, found).sum(1)
        assert (np.diff(score) <= 1e-12).all() and len(np.unique(found, axis=0)) == len(found)
        assert need - 0.08 < np.exp(score).sum() < need + 0.08
        assert len(np.unique(neighbours.bucket_keys(found))) == len(found)


def test_few_vectors_and_none(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (7, [0.5, 0.5]), (20, [0.0, 2.0])], "vec_id long, embedding array<float>")
    got = neighbours.search(few).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.vec_id) for r in got if r.query_id == 0] == [(0, 7), (0, 20)]
    assert neighbours.search(few.limit(0)).count() == 0


P = "<p>" + "Lorem ipsum dolor sit amet consectetur adipiscing elit. " * 6 + "</p>"
LOREM = " ".join(["Lorem ipsum dolor sit amet consectetur adipiscing elit."] * 6)
PAGES = [
    ("<html><body><nav><a href=x>a</a></nav><div class='ad'>buy</div><article><h1>T &amp; U</h1>" + P + "<p>Short.</p></article><footer>f</footer></body></html>", f"T & U {LOREM} Short."),
    ("<body><header><h1>Site</h1></header><div id=menu><a href=x>a</a> <a href=y>b</a></div><div class=content><h1>Title</h1>" + P + "<p>Short.</p><div>" + P + "</div></div><div class=sidebar><p>side</p></div><div>We use cookies.</div><div id=comments><p>" + "nice one " * 90 + "</p></div></body>", f"Title {LOREM} Short. {LOREM}"),
    ("<main><article>" + P + "<form>name <input></form><script>var t='</p>';</script><style>p{}</style></article><section class=comments><article class=comment><p>hey</p></article></section></main>", LOREM),
    ("plain &lt;b&gt;  text", "plain <b> text"),
    ("<p>a<p>b<br>c<b>d</b>e</p></div></p>", "a b cde"),
    ("", ""),
    (None, ""),
    ("<div><div><div>", ""),
    ("<body><article><div class='article-share-image'>" + P + "</div><div class='post related-work'>" + P + "</div></article><div class='related-posts'>" + P + "</div></body>", f"{LOREM} {LOREM}"),
    ("<article>" + P + "<div>We use cookies here. <button>Accept</button></div>" + P + "</article>", f"{LOREM} {LOREM}"),
    ("<body><div role=complementary>" + P + "</div><div hidden>" + P + "</div><div><section>" + P + P + "</section><section>" + P + "</section></div></body>", f"{LOREM} {LOREM} {LOREM}"),
    ("<p title='a > b < c' id=x>quoted</p>", "quoted"),
    ("<article><p>cut off in a tag <a href='x", "cut off in a tag"),
]


@pytest.mark.parametrize("page,want", PAGES[:-1])
def test_main_text_of_pages(page, want):
    assert (main_text.Page(page).main_text() if page else "") == want


def test_main_text_query(spark):
    df = spark.createDataFrame([(i, f"u{i}", h, "x") for i, (h, _) in enumerate(PAGES)] + [(0, "u0", PAGES[0][0], "x")], "page_id long, url string, html string, text string")
    got = main_text.extract(df)
    assert got.columns == ["page_id", "url", "text", "n_chars"] and got.count() == len(PAGES) + 1
    assert all(r.n_chars == len(r.text) for r in got.collect())
    assert main_text.extract(df.limit(0)).count() == 0


def slow_main_text(page):
    """The formula by definition, over a tree of well-formed block elements: (name, [children or texts])."""

    def size(node):
        c = t = link = a = 0
        for x in node[1]:
            if isinstance(x, str):
                c += len(x.replace(" ", ""))
            elif x[0] == "a":
                n = len(x[1][0].replace(" ", ""))
                c, t, link, a = c + n, t + 1, link + n, a + 1
            else:
                n = size(x)
                c, t, link, a = c + n[0], t + 1 + n[1], link + n[2], a + n[3]
        return c, t, link, a

    whole = size(page)

    def density(node):
        c, t, link, a = size(node)
        if not c:
            return 0.0
        t += node is not page
        t = max(1, t)
        base = math.log(c * link / max(1, c - link) + whole[2] / max(1, whole[0]) * c + math.e)
        ratio = math.log(c / max(1, link) * t / max(1, a))
        return c / t * max(0.0, ratio / math.log(base) if base > 1.0000001 else ratio)

    blocks = lambda node: [x for x in node[1] if not isinstance(x, str) and x[0] != "a"]
    order, up = [page], {id(page): None}
    for node in order:
        for x in blocks(node):
            up[id(x)] = node
            order.append(x)
    best = max(order, key=lambda n: sum(map(density, blocks(n))))
    path, node = [], best
    while node is not None:
        path.append(node)
        node = up[id(node)]
    threshold = min(map(density, path)) / 2

    def text(node, kept):
        out = []
        for x in node[1]:
            if isinstance(x, str):
                out.append(x if kept else "")
            elif x[0] == "a":
                out.append(x[1][0] if kept else "")
            else:
                on = any(x is p for p in path)
                branch = any(node is p for p in path) and node is not best and not on
                c, _, link, _ = size(x)
                own = on or (density(x) >= threshold > 0 if branch else kept and not (c and 10 * link >= 8 * c and density(x) < threshold))
                out.append(" " + text(x, own) + " ")
        return "".join(out)

    return " ".join(text(page, True).split())


def test_densities_match_the_formula_on_random_trees():
    rng = random.Random(8)

    def words(n):
        return " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(n)) + " "

    def tree(depth):
        out = []
        for _ in range(rng.randint(1, 4)):
            kind = rng.random()
            if kind < 0.4 or not depth:
                out.append(("div", [words(rng.choice((2, 9, 40)))]))
            elif kind < 0.6:
                out.append(("div", [("a", [words(rng.randint(1, 4))]) for _ in range(rng.randint(1, 6))]))
            else:
                out.append(("div", tree(depth - 1)))
        return out

    def html(node):
        return node if isinstance(node, str) else f"<{node[0]}>" + "".join(map(html, node[1])) + f"</{node[0]}>"

    several = 0
    for _ in range(300):
        page = ("body", tree(3))
        got = main_text.Page(html(page)).main_text()
        assert got == slow_main_text(page)
        several += 0 < len(got) < len(re.sub("<[^>]*>", "", html(page)).strip())
    assert several > 100


def test_unclosed_quotes_take_linear_time():
    page = "<p title='a>text " * 20_000 + '<i x="' * 20_001
    began = time.perf_counter()
    main_text.Page(page).main_text()
    assert time.perf_counter() - began < 10


def test_deep_pages_take_linear_time():
    assert main_text.Page("<div>" * 5000 + "deep" + "</div>" * 5000).main_text() == "deep"


def test_small_and_large_graphs_have_the_same_components(spark, monkeypatch):
    """Chains, rings and stars with negative ids, at once on the driver and by stars; few edges take no plan of their own but the reading."""
    from terrazzo.llm import components

    edges = [(k + 1, k) for k in range(-30, 30)] + [(100 + k, 100 + (k + 3) % 11) for k in range(11)] + [(200, 200 + k) for k in range(1, 9)] + [(5, 5)]
    table = spark.createDataFrame(edges, "a long, b long")
    rounds = []
    star = components.large_star
    monkeypatch.setattr(components, "large_star", lambda e: rounds.append(1) or star(e))
    small = {r.node: r.component for r in components.components(table, len(edges)).collect()}
    assert not rounds
    large = {r.node: r.component for r in components.components(table, components.SMALL + 1).collect()}
    assert rounds and small == large and small == {**{k: -30 for k in range(-30, 31)}, **{100 + k: 100 for k in range(11)}, **{200 + k: 200 for k in range(9)}}
    names = spark.createDataFrame([("b", "a"), ("c", "b"), ("x", "y")], "a string, b string")
    assert {tuple(r) for r in components.components(names, 3).collect()} == {("a", "a"), ("b", "a"), ("c", "a"), ("x", "x"), ("y", "x")}
