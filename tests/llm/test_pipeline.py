"""The stages of the document pipeline against brute force."""

import hashlib
import random
import re
from collections import Counter

import duckdb
import numpy as np
import sentencepiece

import corpus_pipeline
from terrazzo.llm import common, mixture, quality

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], COLUMNS)


def sets_of(text, width=5):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def jaccard(a, b, width=5):
    x, y = sets_of(a, width), sets_of(b, width)
    return len(x & y) / len(x | y) if x and y else 0.0


def without_near_copies(rows):
    """Rows whose id is null, or the least of the ids that links of 0.8 or more reach from it."""
    group = {i: i for i, _ in rows if i is not None}
    for _ in rows:
        for i, s in rows:
            for j, t in rows:
                if i is not None and j is not None and jaccard(s, t) >= 0.8:
                    group[i] = group[j] = min(group[i], group[j])
    return [(i, t) for i, t in rows if i is None or group[i] == i]


def near_rows():
    rng = random.Random(6)
    fresh = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]

    def changed(words, *places):
        return [f"new{k}" if k in places else w for k, w in enumerate(words)]

    a, b, c, d, e = fresh(50), fresh(100), fresh(200), fresh(50), fresh(300)
    texts = [a, changed(a, 25), b, changed(b, 30, 70), c, [*c, *fresh(30)], d, changed(d, 15, 35), e, changed(e, 100, 200), fresh(40)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    return [*rows, (20, None), (21, ""), (None, rows[0][1]), (None, rows[0][1]), (10, rows[10][1])]


def test_near_copies_between_the_thresholds_leave(spark):
    rows = near_rows()
    between = [(0, 1), (2, 3), (4, 5)]
    assert all(jaccard(rows[i][1], rows[j][1]) >= 0.8 and jaccard(rows[i][1], rows[j][1], 3) < 0.9 for i, j in between)
    got = corpus_pipeline.near_duplicates(spark, documents(spark, rows), "")
    assert got.columns == list(corpus_pipeline.COLUMNS)
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(without_near_copies(rows), key=str)


def redacted(text):
    from terrazzo.llm import secrets

    spans = sorted((m.start(), m.end()) for rx, group, least in secrets.RULES.values() for m in re.finditer(rx, text or "", re.ASCII) if len(m.group(group)) >= least)
    out, at = "", 0
    for a, b in spans:
        if a >= at:
            out += text[at:a] + "[secret]"
        at = max(at, b)
    return None if text is None else out + text[at:]


def test_run_matches_brute_force_stage_by_stage(spark, tmp_path):
    """A small corpus through all stages: each against a slow version of its own, on what the slow ones before it kept."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choices("abcdefghijklmno", k=rng.randint(3, 7)))
    rows = []
    for i in range(60):
        text = " ".join(["the", "and", "of", *(word() for _ in range(60))])
        rows.append((i, text + (" token = abcdef99 and more" if i % 7 == 0 else "")))
    rows += [(100 + i, rows[i][1] + " one more word") for i in range(5)]
    rows += [(200, "too short"), (201, None), (202, ""), (203, "### *** %%% " * 30), (None, rows[3][1]), (3, rows[3][1])]
    docs = documents(spark, rows)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 40, 2)] + [(203, 0, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))

    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    verdicts = con.execute(quality.assess_sql()).fetchall()
    names = [d[0] for d in con.description]
    good = {(r[names.index("doc_id")], r[names.index("n_words")], r[names.index("word_chars")]) for r in verdicts if r[names.index("kept")]}
    size = lambda t: (len((t or "").split()), sum(map(len, (t or "").split())))
    after = [[(i, t) for i, t in rows if (i, *size(t)) in good]]
    after.append(without_near_copies(after[0]))
    after.append([(i, redacted(t)) for i, t in after[1]])
    order = lambda rs: sorted(rs, key=str)
    table = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for (_, stage), want in zip(corpus_pipeline.STAGES[:3], after, strict=True):
        table = common.stored(stage(spark, table, str(tmp_path)), "test")
        assert table.columns == list(corpus_pipeline.COLUMNS)
        assert order((r.doc_id, r.text) for r in table.collect()) == order(want)
    mixed = common.stored(corpus_pipeline.mixing(spark, table, str(tmp_path)), "test")
    told = labels.selectExpr("doc_id", f"{mixture.DOMAIN} as domain")
    times = Counter()
    for r in mixture.mix(table, told, mixture.TARGETS).collect():
        p = np.array(r.posterior)
        assert abs(p.sum() - 1) < 1e-9 and r.rate >= 0
        times[r.doc_id] += int(r.rate)
    found = Counter(r.doc_id for r in mixed.collect())
    assert set(found) <= {i for i, _ in after[2]} and all(0 <= found[i] - n <= max(1, sum(j == i for j, _ in after[2])) for i, n in times.items())
    library = sentencepiece.SentencePieceProcessor(model_file=common.vocabulary("piece_bpe_32k.model"))
    want = []
    for r in mixed.collect():
        ids = library.encode(r.text or "")
        want.append((r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    got = [tuple(r) for r in corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()]
    assert order(got) == order(want)


def test_stages_take_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    empty = documents(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0


def test_mixing_hands_texts_to_python_once_and_gets_none_back(spark, tmp_path):
    """Kept columns with the texts stay in Spark, so a task's memory for Python doesn't grow with what passes through."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    rng = random.Random(3)
    rows = [(i, " ".join("".join(rng.choices(letters, k=6)) for _ in range(300))) for i in range(200)]
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(i, "clean" if i % 2 else "rough") for i in range(0, 200, 3)], "doc_id long, domain string")
    domains = list(mixture.TARGETS)
    with common.held(spark, "spark.sql.adaptive.enabled", "false"):
        model = mixture.fit(docs, labels, domains, "doc_id", "text")
        judged = mixture.posteriors(docs, model, domains, "doc_id", "text", None, corpus_pipeline.COLUMNS)
        plan = judged._jdf.queryExecution().executedPlan()
        got = judged._jdf.queryExecution().toRdd().count()
    assert got == len(rows)
    assert "MapInArrow" not in plan.toString()

    def metrics(node):
        own = node.metrics()
        found = [(own.apply(k).value()) for k in ("pythonDataSent", "pythonDataReceived") if own.contains(k)]
        kids = node.children()
        return [found] * bool(found) + [m for k in range(kids.size()) for m in metrics(kids.apply(k))]

    (sent, received), size = metrics(plan)[0], sum(len(t) for _, t in rows)
    assert size < sent < 1.5 * size and received < size / 10
