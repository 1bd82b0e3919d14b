"""The operators against brute force, and on odd tables: nulls, empty and long texts, ties, repeated rows, no rows."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import embed_dedup, media, minhash, mixing, ngram_lm, quality, sentencepiece_codec, token_binary, toxicity, url_filter

P = pytest.importorskip("public_tokenizers")
DOCS = "doc_id long, text string, source string, lang string, n long, id string, score string, copies int"


def words(text):
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", folded)


def odd_docs(spark, rnd=None):
    rnd = rnd or random.Random(4)
    vocabulary = ["uno", "dos", "tres", "cuatro", "Señor", "ley", "agua", "ÁRBOL", "x1", "日本"]
    texts = [" ".join(rnd.choice(vocabulary) for _ in range(rnd.randrange(0, 40))) for _ in range(40)]
    texts += [None, "", "  \n\t ", "a", "a b c d", "A B c D", "a b c d e", "w " * 20_000 + "end", texts[0], texts[0] + " más", "x" * 5000]
    rows = [(i, t, rnd.choice(["s1", "s2", None]), "es", i, "z", "q", 3) for i, t in enumerate(texts)]
    rows += [rows[0], rows[0], (None, texts[1], "s1", None, None, None, None, None), (None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS), rows


@pytest.fixture(scope="module")
def odd(spark):
    return odd_docs(spark)


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


# ---------------------------------------------------------------- 1 mixing


def water_level(sizes, weights, share, cap):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, target = share * sum(sizes.values()), set(names), {}
    while open_:
        total = sum(w[s] for s in open_)
        full = {s for s in open_ if left * w[s] / total > cap * sizes[s] + 1e-9}
        if not full:
            target |= {s: left * w[s] / total for s in open_}
            break
        for s in full:
            target[s] = cap * sizes[s]
            left -= target[s]
        open_ -= full
    return target


def test_mixing(odd, no_docs):
    df, rows = odd
    sizes = defaultdict(int)
    for _, t, s, *_ in rows:
        sizes[s] += len(words(t))
    target = water_level(sizes, (3, 1, 2), 1.5, 2.0)
    got = mixing.mix_sources(df.withColumn("size", F.lit("clash"))).collect()
    assert len(got) == len(rows)
    taken = defaultdict(int)
    by_size = {v: k for k, v in sizes.items()}
    assert len(by_size) == len(sizes)
    for r in got:
        source = by_size[r["source_size"]]
        assert r["target"] == pytest.approx(target[source]) and r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
        taken[source] += r["taken"]
    longest = {s: max(len(words(t)) for _, t, x, *_ in rows if x == s) for s in sizes}
    for s, t in target.items():  # whole copies: one text may hold most of a source's words
        assert abs(taken[s] - t) <= 0.02 * t + longest[s] / 2
    again = mixing.mix_sources(df.repartition(7)).collect()
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["size"], r["taken"])
    assert sorted(map(key, got)) == sorted(map(key, again))
    assert mixing.mix_sources(no_docs).count() == 0


def plain_tilt(sizes, target, cap):
    """exp(tilt * size / mean) clipped at cap, by bisection in numpy."""
    z = sizes / sizes.mean()
    low, high = -200.0, 200.0
    for _ in range(200):
        middle = (low + high) / 2
        if (sizes * np.minimum(cap, np.exp(np.minimum(middle * z, 40)))).sum() < target:
            low = middle
        else:
            high = middle
    return np.minimum(cap, np.exp(low * z))


def test_rates_are_the_tilt_of_documents(spark):
    """Of the documents that aren't balanced again, against a plain solution of the same dual."""
    rnd = np.random.default_rng(5)
    rows = [(i, "w " * int(n), f"s{i % 4}") for i, n in enumerate(np.exp(rnd.normal(3, 1.2, 800)).astype(int) + 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for share in (1.5, 1.98):
        got = mixing.mix_sources(docs, share=share, fine_share=0.0).collect()
        for source in {r["source"] for r in got}:
            own = [r for r in got if r["source"] == source]
            sizes, target = np.array([r["size"] for r in own], float), own[0]["target"]
            want = np.full(len(own), 2.0) if target >= 2 * sizes.sum() else plain_tilt(sizes, target, 2.0)
            assert np.allclose([r["rate"] for r in own], want, atol=1e-5), (source, share)
        rates = {(r["source"], r["size"]): r["rate"] for r in got}
        assert len(set(rates.values())) > 100 or share != 1.5


def test_mixing_of_one_hot_source(spark):
    rnd = random.Random(9)
    rows = [(i, "w " * rnd.choice([1, 7, 7, 7, 90]), "hot" if i % 3 else f"s{i % 9}") for i in range(900)]
    got = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string"), rows_per_bucket=16).collect()
    for size, group in {r["source_size"]: [x for x in got if x["source_size"] == r["source_size"]] for r in got}.items():
        assert abs(sum(x["taken"] for x in group) / group[0]["target"] - 1) < 0.01, size


def test_mixed_rows_are_what_the_mix_takes(odd, no_docs):
    df, rows = odd
    seen, once = set(), []
    for r in rows:
        if r[0] is None or r[0] not in seen:
            seen.add(r[0])
            once.append(r)
    df = df.sparkSession.createDataFrame([*once, (None, "uno dos", "s1", *once[0][3:]), (None, "dos uno", "s1", *once[0][3:])], DOCS)
    taken = Counter()
    for r in mixing.mix_sources(df).collect():
        taken[r["doc_id"], r["source"], r["size"]] += r["copies"]
    mixed = mixing.mixed_documents(df)
    assert mixed.columns == df.columns
    assert Counter((r["doc_id"], r["source"], len(words(r["text"]))) for r in mixed.collect()) == +taken
    assert mixing.mixed_documents(no_docs).count() == 0


# ---------------------------------------------------------------- 2 URL filters


def test_rules_and_hosts(spark):
    urls = [
        ("HTTP://A.Example.ORG/es/x?q", "a.example.org", "/es/x", "example.org/es/", "block"),
        ("http://example.org/en/17", "example.org", "/en/17", "example.org/en/1", "block"),
        ("http://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
        ("http://example.org", "example.org", "", None, None),
        ("http://notexample.com/de/1#x", "notexample.com", "/de/1", "com/de/", "block"),
        ("a://b.com://c/fr/", "b.com:", "//c/fr/", None, None),
        ("no scheme/fr/", "", "", None, None),
        (None, "", "", None, None),
        ("", "", "", None, None),
    ]
    df = spark.createDataFrame([(i, u[0], None, "clash") for i, u in enumerate(urls)] + [(None, None, None, None)], "page_id long, url string, html string, rule string")
    got = {r["page_id"]: r for r in url_filter.filter_urls(df).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(urls):
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule)
        assert got[i]["verdict"] == (verdict or "allow")
    assert len(got) == len(urls) + 1 and url_filter.filter_urls(df.limit(0)).count() == 0


def test_link_graph(spark):
    """Ranks as plain power iteration gives, and verdicts that follow links."""
    links = {"t.org": ["a.net", "b.net"], "a.net": ["b.net"], "spam.net": ["x.com"], "x.com": ["a.net"], "b.net": [], "bad.net": ["spam.net", "x.com"]}
    rows = []
    for i, (h, out) in enumerate(links.items()):
        path = {"t.org": "/", "x.com": "/de/1"}.get(h, "/p")
        rows.append((i, f"http://{h}{path}", " ".join(f'<a href="http://{o}/p">x</a> <a href="/self">y</a>' for o in out)))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    edges = {(r["src"], r["dst"]): r["weight"] for r in url_filter.host_edges(df).collect()}
    assert edges == {(h, o): 1.0 for h, out in links.items() for o in out}

    odd = ["<a href='//b.net/x'>", '<base href="http://far.net/d/"><a href="p">', '<base href="http://far.net/d/"><a href="#top">', '<base href="//far.net"><a href=q>', None, "", '<a href="mailto:x@y.z">', "<a href='HTTPS://B.net'> " * 2000]
    found = url_filter.host_edges(spark.createDataFrame([(i, "http://a.net/", h) for i, h in enumerate(odd)] * 2, "page_id long, url string, html string")).collect()
    assert {(r["src"], r["dst"], r["weight"]) for r in found} == {("a.net", "b.net", 4.0), ("a.net", "far.net", 4.0)}

    def power(edges, seeds):
        rank = {s: 1 / len(seeds) for s in seeds}
        for _ in range(200):
            new = defaultdict(float)
            for (a, b), w in edges.items():
                new[b] += 0.85 * rank.get(a, 0) * w / sum(v for (c, _), v in edges.items() if c == a)
            back = 1 - sum(new.values())
            for s in seeds:
                new[s] += back / len(seeds)
            rank = dict(new)
        return rank

    got = {r["host"]: r for r in url_filter.filter_urls(df).collect()}
    trust, distrust = power(edges, ["t.org"]), power({(b, a): w for (a, b), w in edges.items()}, ["x.com"])
    for h, r in got.items():
        assert r["trust"] == pytest.approx(trust.get(h, 0), abs=1e-6) and r["distrust"] == pytest.approx(distrust.get(h, 0), abs=1e-6)
    assert [got[h]["verdict"] for h in ("t.org", "a.net", "spam.net", "bad.net", "x.com")] == ["allow", "allow", "block", "block", "block"]


def test_ranks_in_a_cycle_converge(spark):
    """Two hosts that link each other move for long; both ranks are the fixed point, and repeated pages are judged each."""
    edges = spark.createDataFrame([("a", "b", 1.0), ("b", "a", 2.0), ("b", "c", 1.0), ("c", "a", 1.0)], "src string, dst string, weight double")
    one, two, none = (spark.createDataFrame(v, "host string") for v in ([("a",)], [("c",)], []))
    got = {r["host"]: r for r in url_filter.propagate(edges, one, two).collect()}
    step = {"a": {"b": 1.0}, "b": {"a": 2 / 3, "c": 1 / 3}, "c": {"a": 1.0}}
    back = {"b": {"a": 1.0}, "a": {"b": 2 / 3, "c": 1 / 3}, "c": {"b": 1.0}}
    for name, links, seed in (("trust", step, "a"), ("distrust", back, "c")):
        rank = {h: float(h == seed) for h in "abc"}
        for _ in range(400):
            rank = {h: 0.15 * (h == seed) + 0.85 * sum(rank[g] * links[g].get(h, 0) for g in "abc") for h in "abc"}
        assert all(got[h][name] == pytest.approx(rank[h], abs=1e-7) for h in "abc")
    only = {r["host"]: (r["trust"], r["distrust"]) for r in url_filter.propagate(edges, none, two).collect()}
    assert all(t == 0 for t, _ in only.values()) and sum(d for _, d in only.values()) == pytest.approx(1)
    assert url_filter.propagate(edges, none, none).count() == 0
    page = (1, "http://x.org/", "<a href='http://y.com/'>" * 5000)
    assert url_filter.filter_urls(spark.createDataFrame([page, page], "page_id long, url string, html string")).count() == 2


# ---------------------------------------------------------------- 3 and 6 classifiers


def labelled(spark, marks, n=600, times=3):
    """Documents of random syllables, half of them with some of the marks."""
    rnd = random.Random(11)
    docs, labels = [], []
    for i in range(n):
        w = ["".join(rnd.choice(["ba", "ko", "ti", "se"]) for _ in range(3)) for _ in range(40)]
        y = i % 2
        if y:
            for m in rnd.choices(marks, k=times):
                w[rnd.randrange(len(w))] = m
        docs.append((i, " ".join(w)))
        labels.append((i, y, y))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity(spark, odd, no_docs):
    docs, labels = labelled(spark, ["rascal", "villain", "scoundrel", "knave"])
    more = spark.createDataFrame([(9000, "ba ko raskal villian scoundrol se"), (9001, 'he said "rascal villain knave" ti'), (9002, None), (9003, "")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in toxicity.classify_toxicity(docs.unionByName(more), labels).collect()}
    held = [i for i in range(600) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(got[i]["held_out"] == (i in held) for i in range(600))
    assert sum(got[i]["predicted"] == i % 2 for i in held) / len(held) > 0.97
    assert got[9000]["score"] > got[9002]["score"]  # misspelled terms speak too
    assert got[9001]["score"] < min(got[i]["score"] for i in held if i % 2)  # quoted ones less than the same in the open
    assert got[9002]["score"] == got[9003]["score"] and got[9002]["predicted"] == 0
    df, rows = odd
    odd_scores = toxicity.classify_toxicity(df, labels).collect()
    assert len(odd_scores) == len(rows) and all(0 <= r["score"] <= 1 for r in odd_scores)
    assert toxicity.classify_toxicity(no_docs, labels.limit(0)).count() == 0


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        new = [i]
        for j, d in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return row[-1]


def plain_toxic_score(terms, weights, coefficients, text):
    """The score of one text, word by word."""
    low = text.lower()
    spans = [(m.start(), m.group()) for m in re.finditer(r"\w+", low)]
    hits = []
    for i, (at, w) in enumerate(spans):
        fit = [(distance(w, t), k) for k, t in enumerate(terms) if abs(len(w) - len(t)) <= 2 and distance(w, t) <= toxicity.allowed_errors(t)]
        if fit:
            errors, k = min(fit)
            before, after = low[:at], low[at:]
            straight = before.count('"') % 2 == 1 and '"' in after
            curly = sum(before.count(c) for c in "“«„‹") > sum(before.count(c) for c in "”»›") and any(c in after for c in "”»›")
            hits.append((i, k, errors, straight or curly))
    exact, loose, cited = ([h for h in hits if ok(h)] for ok in (lambda h: not h[3] and not h[2], lambda h: not h[3] and h[2], lambda h: h[3]))
    places = [h[0] for h in hits if not h[3]]
    crowd = max((sum(abs(p - q) <= toxicity.WINDOW for q in places) - 1 for p in places), default=0)
    total = lambda found: math.log1p(sum(weights[h[1]] for h in found))
    x = [1, total(exact), max((weights[h[1]] for h in exact), default=0), total(loose), total(cited), math.log1p(crowd), math.log1p(len({h[1] for h in exact}))]
    return 1 / (1 + math.exp(-sum(a * b for a, b in zip(x, coefficients, strict=True))))


def test_toxic_scores_are_those_of_a_plain_scorer(spark, odd):
    deseret = "".join(chr(0x10428 + k) for k in range(7))  # letters beyond two bytes are letters
    docs, labels = labelled(spark, ["rascal", "villain", "scoundrel", "ox", deseret])
    matcher, weights, coefficients = toxicity.fit_toxicity(docs, labels)
    assert {"rascal", "villain", "scoundrel", "ox", deseret} <= set(matcher.terms)
    rnd = random.Random(3)
    texts = [r["text"] for r in docs.limit(60).collect()] + [t or "" for _, t, *_ in odd[1]]
    bits = ["rascal", "Rascall", "vilain", "“", "”", '"', "ox", "oxe", "scoundrle", "ba", "𝐫", ".", deseret, deseret[1:], "x" * 300, "\n"]
    texts += [" ".join(rnd.choices(bits, k=rnd.randrange(30))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in toxicity.classify_toxicity(df, labels.unionByName(labels)).collect()}
    assert len(matcher.terms) < 60
    again = toxicity.fit_toxicity(docs, labels)[2]
    assert np.allclose(coefficients, again)
    scored = toxicity._scores(matcher, weights, coefficients, "score")
    import pyarrow as pa

    (batch,) = pa.Table.from_batches(list(scored(iter([pa.RecordBatch.from_pydict({"text": texts})])))).combine_chunks().to_batches()
    for text, score in zip(texts, batch.column("score").to_pylist(), strict=True):
        assert score == pytest.approx(plain_toxic_score(matcher.terms, weights, coefficients, text), abs=1e-9), text[:200]
    assert len(got) == len(texts)


def test_many_terms_and_repeated_labels(spark):
    """No term is left out for being one of many; an id that many rows bear is one document of the sample."""
    from tessera.llm.labelled import labelled_sample

    docs = spark.range(3000).selectExpr("id % 10 as doc_id", "concat('text ', id) as text")
    labels = spark.range(10).selectExpr("id as doc_id", "1 as toxic")
    sample = labelled_sample(docs, labels, "toxic", {0: 5, 1: 5000}, 1)
    assert sample.count() == sample.select("doc_id").distinct().count() > 3
    names = ["".join(chr(97 + (k * m) % 26) for m in (1, 3, 7, 11, 17, 19)) + f"{k}" for k in range(700)]
    rows = [(1, " ".join(f"{a}{j} {w} {b}{j}" for w in names[k::7])) for j, (a, b) in enumerate([("p", "q")] * 8) for k in range(7)]
    rows += [(0, f"p{k} q{k} plain") for k in range(600)]
    lexicon = toxicity.learn_lexicon(spark.createDataFrame(rows, "y int, text string"))
    assert set(names) <= set(lexicon)


def test_misspellings_are_edit_distances():
    terms = ["rascal", "villain", "knave", "scoundrel", "ruin"]
    rnd, matcher, tried = random.Random(1), toxicity.Matcher(terms), []
    for _ in range(1500):
        w = list(rnd.choice(terms))
        for _ in range(rnd.randrange(4)):
            k, at = rnd.randrange(3), rnd.randrange(len(w))
            w[at : at + (k != 0)] = [] if k == 1 and len(w) > 1 else [rnd.choice("arsceñ1")]
        tried.append("".join(w))
    points, sizes = np.frombuffer("".join(tried).encode("utf-32-le"), np.uint32), np.array([len(w) for w in tried])
    word, term, errors = matcher.match(points, np.cumsum(sizes) - sizes, sizes)
    got = dict(zip(word.tolist(), errors.tolist(), strict=True))
    for i, w in enumerate(tried):
        fit = [distance(w, t) for t in terms if distance(w, t) <= toxicity.allowed_errors(t)]
        assert got.get(i) == (min(fit) if fit else None), w


def test_quality(spark, odd, no_docs):
    docs, labels = labelled(spark, ["###", "!!!x", "$$$"], 500, 12)
    labels = labels.withColumn("quality", 1 - F.col("quality"))
    got = {r["doc_id"]: r for r in quality.classify_quality(docs.withColumn("score", F.lit(1)), labels).collect()}
    held = [i for i in range(500) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum(got[i]["predicted"] == 1 - i % 2 for i in held) / len(held) > 0.9
    df, rows = odd
    one, two = ({(r["doc_id"], round(r["score"], 6)) for r in quality.classify_quality(df.repartition(n), labels).collect()} for n in (1, 5))
    assert one == two and quality.classify_quality(df, labels.limit(0)).where("score = 0.5").count() == len(rows)
    assert quality.classify_quality(no_docs, labels).count() == 0


def plain_quality_score(odds, text):
    """Every word and character gram hashed and looked up one by one."""
    from tessera.llm.hashing import span_hashes

    mask, shift = (1 << 64) - 1, 64 - quality.BITS

    def mixed(x):
        x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & mask
        x = (x ^ (x >> 27)) * 0x94D049BB133111EB & mask
        return x ^ (x >> 31)

    found = [float(odds[0])]
    for w in re.findall(r"[^\x20\x09-\x0D]+", text):
        raw = np.frombuffer(w.encode(), np.uint8)
        with np.errstate(over="ignore"):
            found.append(float(odds[int(span_hashes(raw, np.array([0]), np.array([len(raw)]), fold=False)[0]) >> shift]))
    spaces = " \t\n\x0b\x0c\r"
    for n in quality.GRAMS:
        for k in range(len(text) - n + 1):
            gram = text[k : k + n]
            if not any(c in spaces for c in gram[1:-1]):
                total = n * 0x2545F4914F6CDD1D & mask
                for j, c in enumerate(gram):
                    code = mixed(((32 if c in spaces else ord(c) & 0xFFFF) + 3) * 0x9E3779B97F4A7C15 & mask)
                    total = (total + code * int(quality._FACTORS[j])) & mask
                found.append(float(odds[total >> shift]))
    return 1 / (1 + math.exp(-sum(found) / len(found)))


def test_quality_scores_are_those_of_a_plain_scorer(odd):
    import pyarrow as pa

    odds = np.random.default_rng(4).normal(size=1 << quality.BITS).astype(np.float32)
    texts = [t or "" for _, t, *_ in odd[1] if t is None or len(t) < 3000] + ["a\tb  c", "naïve 😀😀 x"]
    out = pa.Table.from_batches(list(quality._score(odds)(iter([pa.RecordBatch.from_pydict({"text": texts})]))))
    for text, score in zip(texts, out.column("score").to_pylist(), strict=True):
        assert score == pytest.approx(plain_quality_score(odds, text), abs=1e-6), text


# ---------------------------------------------------------------- 4 token ids and 8 SentencePiece


def test_codes_round_trip():
    rnd = np.random.default_rng(3)
    for ids in (np.zeros(0, int), np.array([0]), rnd.integers(0, 256, 700), rnd.integers(0, 50_000, 5000), np.array([2**32 - 1, 0, 255, 256, 65_536, 1 << 24])):
        codes = token_binary.Codes(token_binary.pack(ids))
        assert (codes.all() == ids).all() and len(codes) == len(ids)
        assert all(codes[i] == ids[i] for i in range(0, len(ids), 37))
    with pytest.raises(IndexError):
        codes[6]


ODD_TEXTS = ["", "  a  b \n c", "x<|endoftext|> y", "it's\xa0 ok", "\n\n a\t\tb", "  ", "日本語 テキスト　全角😀", "a\x1c b", "don't  stop\r\n  now 123abc!!", "x" * 300 + "ab" * 200, "a▁b", "ﬁ Å é", "    deep\n        code"]


def test_token_files(spark, odd, no_docs, tmp_path):
    from tokenizers import Tokenizer

    path = P.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    df, rows = odd
    df = df.unionByName(spark.createDataFrame([(1000 + i, t) for i, t in enumerate(ODD_TEXTS)], "doc_id long, text string"), allowMissingColumns=True)
    got = token_binary.encoded_digests(df, str(tmp_path / "ids"), path).orderBy("start").collect()
    expected = sorted([(d, t or "") for d, t, *_ in rows] + [(1000 + i, t) for i, t in enumerate(ODD_TEXTS)], key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    start = 0
    for r, (doc_id, text) in zip(got, expected, strict=True):
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 2], "<u4")
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (doc_id, start, len(ids), zlib.crc32(ids.tobytes())), text
        start += len(ids)
    want = library.encode(ODD_TEXTS[8], add_special_tokens=False).ids
    asked = spark.createDataFrame([(1008, 0), (1008, 3), (1008, len(want)), (1008, len(want) + 1), (1008, -1), (1008, None), (77777, 0), (None, 5)], "doc_id long, place long")
    expected = {(1008, 0, want[0]), (1008, 3, want[3]), (1008, len(want), 2), (1008, len(want) + 1, None), (1008, -1, None), (1008, None, None), (77777, 0, None), (None, 5, None)}
    for together in (1, 500_000):
        assert {tuple(r) for r in token_binary.ids_at(spark, str(tmp_path / "ids"), asked, together).collect()} == expected
    assert token_binary.read_token_ids(spark, str(tmp_path / "ids")).where("doc_id = 1008").first()["ids"] == [*want, 2]
    assert token_binary.encoded_digests(no_docs, str(tmp_path / "none"), path).count() == 0


def test_other_tokenizers_go_through_the_library():
    """A file that says it cuts otherwise is never cut here."""
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    library, own = Tokenizer.from_file(path), token_binary.PieceEncoder(path)
    assert not own.plain and token_binary.PieceEncoder(P.path("byte_bpe_50k.json")).plain
    for text, ids in zip(ODD_TEXTS, own.encode(ODD_TEXTS), strict=True):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_sentencepiece_is_the_library(spark, odd, no_docs):
    from sentencepiece import SentencePieceProcessor

    path = P.path("piece_bpe_32k.model")
    library = SentencePieceProcessor(model_file=path)
    rnd = random.Random(3)
    texts = ODD_TEXTS + ["".join(rnd.choice("aabcde  ▁\nüéthing日😀") for _ in range(rnd.randrange(300))) for _ in range(60)]
    codec = sentencepiece_codec.Codec(path, most=50)  # a small store, so it is emptied on the way
    for t in texts:
        ids = codec.encode([t])[0]
        assert ids.tolist() == library.encode(t), t
        assert codec.decode([ids])[0] == library.decode(ids.tolist()) == t.replace("▁", " ")
    df, rows = odd
    got = sentencepiece_codec.round_trips(df, path).collect()
    assert len(got) == len(rows) and all(r["round_trip"] for r in got)
    back = sentencepiece_codec.decode_ids(sentencepiece_codec.encode_texts(df.withColumn("ids", F.lit("clash")), path), path)
    assert back.where("decoded <> coalesce(text, '')").count() == 0
    assert sentencepiece_codec.round_trips(no_docs, path).count() == 0


def test_viterbi_is_the_best_path():
    """On random scores, against a plain dynamic programme over one word at a time."""
    codec = sentencepiece_codec.Codec(P.path("piece_bpe_32k.model"), kind="unigram")
    codec.scores = np.random.default_rng(2).normal(-8, 3, len(codec.scores)).astype(np.float32)
    ids_of = dict(zip(codec.keys.tolist(), codec.key_ids.tolist(), strict=True))
    word_list = ["▁" + w for w in ("international", "the", "straßenbahn", "naïve", "x😀y", "aaaaaaa")]
    got = dict(zip(word_list, codec.encode([w[1:] for w in word_list]), strict=True))
    unknown = float(codec.scores[codec.key_ids].min()) - 10
    for w in word_list:
        points = np.array([[ord(c) for c in w]], np.uint32)
        table = codec.piece_table(points)[0]
        best = [0.0] + [-math.inf] * len(w)
        for end in range(1, len(w) + 1):
            for begin in range(max(0, end - codec.longest), end):
                i = table[begin, end - begin - 1]
                s = float(codec.scores[i]) if i >= 0 else unknown if end - begin == 1 else -math.inf
                best[end] = max(best[end], best[begin] + s)
        plain = [i for i in got[w].tolist() if i in ids_of.values()]
        n_unknown = sum(table[k, 0] < 0 for k in range(len(w)))
        assert sum(float(codec.scores[i]) for i in plain) + n_unknown * unknown == pytest.approx(best[-1], rel=1e-4), w


# ---------------------------------------------------------------- 5 media


def wav(samples, rate=media.RATE):
    import io
    import wave

    out = io.BytesIO()
    with wave.open(out, "wb") as f:
        f.setnchannels(1)
        f.setsampwidth(2)
        f.setframerate(rate)
        f.writeframes((np.clip(samples, -1, 1) * 32767).astype("<i2").tobytes())
    return out.getvalue()


def test_recordings(spark):
    rnd = np.random.default_rng(8)
    songs = [media.note_samples(rnd.normal(size=60).tolist()) for _ in range(6)]
    noisy = songs[0] + rnd.normal(scale=0.02, size=len(songs[0]))
    late = songs[1][5 * media.HOP :]
    cells = [*songs, noisy, late, songs[2], np.zeros(40_000), np.zeros(100)]
    rows = [(i, wav(s)) for i, s in enumerate(cells)] + [(50, None), (None, wav(songs[3])), (3, wav(songs[3]))]
    df = spark.createDataFrame(rows, "media_id long, audio binary")
    got = defaultdict(list)
    for r in media.match_recordings(df, "media_id", "audio").collect():
        got[r["media_id"]].append(r)
    part = {i: got[i][0]["component_id"] for i in got if i is not None}
    assert part[6] == 0 and part[7] == 1 and part[8] == 2 and len({part[i] for i in range(6)}) == 6
    assert got[10][0]["n_prints"] == 0 and got[50][0]["n_prints"] == 0 and got[50][0]["kept"] and len(got[3]) == 2
    assert got[None][0]["component_id"] is None
    assert media.match_recordings(df.limit(0), "media_id", "audio").count() == 0


def aligned_parts(cells):
    """Smallest recording that links reach, by bit_error_rate at every offset of every pair; and the linked pairs."""
    prints = [media.fingerprint(media.chroma(media.wav_samples(c))) for c in cells]
    pairs = []
    for i, a in enumerate(prints):
        for j, b in enumerate(prints[:i]):
            rates = [media.bit_error_rate(a, b, d) for d in range(-len(b), len(a) + 1)]
            if any(e <= media.MOST_ERRORS and n >= media.LEAST_OVERLAP * min(len(a), len(b)) for e, n in rates):
                pairs.append((i, j))
    part = list(range(len(cells)))
    for _ in cells:
        for i, j in pairs:
            part[i] = part[j] = min(part[i], part[j])
    return part, pairs, prints


def test_noisy_recordings_are_those_that_align(spark):
    """Up to MOST_ERRORS, with no integers in a row alike, as by brute-force alignment."""
    rnd = np.random.default_rng(18)
    songs = [media.note_samples(rnd.normal(size=70).tolist()) for _ in range(8)]
    cut = [s[k * media.HOP + 100 * k :] for k, s in enumerate(songs)]
    cells = [wav(s) for s in songs] + [wav(0.5 * s + rnd.normal(scale=scale, size=len(s))) for scale in (0.1, 0.2, 0.3, 0.4, 0.5) for s in cut]
    part, pairs, prints = aligned_parts(cells)
    runs = [{tuple(f[k : k + 3]) for k in range(len(f) - 2)} for f in map(np.ndarray.tolist, prints)]
    assert sum(not runs[i] & runs[j] for i, j in pairs) >= 5  # some pairs share no three integers
    df = spark.createDataFrame(list(enumerate(cells)), "media_id long, audio binary")
    found = media.match_recordings(df, "media_id", "audio").collect()
    got = {r["media_id"]: r["component_id"] for r in found}
    exact = {r["media_id"]: r["component_id"] for r in media.match_recordings(df, "media_id", "audio", exact=True).collect()}
    assert [exact[i] for i in range(len(part))] == part
    wrong = [i for i, p in enumerate(part) if got[i] != p]
    assert len(wrong) <= 0.1 * len(part), f"{len(wrong)} of {len(part)}"
    assert not found[0]["exact"] and found[0]["audit_recall"] > 0.95  # the votes found them


@pytest.mark.parametrize("together", [1 << 22, 500])
def test_votes_find_what_every_offset_does(monkeypatch, together):
    monkeypatch.setattr(media, "VOTES_TOGETHER", together)
    rnd = np.random.default_rng(21)
    songs = [rnd.integers(0, 1 << 32, rnd.integers(40, 90), np.uint32) for _ in range(40)]
    noisy = [f[k % 7 :] ^ np.bitwise_or.reduce([(rnd.random(len(f) - k % 7) < 0.08).astype(np.uint32) << np.uint32(b) for b in range(32)]) for k, f in enumerate(songs)]
    still = [np.full(50, 7, np.uint32), np.full(60, 7, np.uint32)]
    one, two = songs + still, noisy + still
    assert (media.voted(one, two) == media.matches(one, two)).all() and media.voted(one, two).sum() == 40
    both = songs + noisy
    assert (media.voted(both) == media.matches(both)).all() and media.voted(both).sum() == 80


def test_exact_where_votes_fall_short(spark, monkeypatch):
    """Where the audit's recall is below what is asked, every offset is compared."""
    monkeypatch.setattr(media, "RECALL", 1.1)
    cells = [wav(media.note_samples(np.random.default_rng(k // 2).normal(size=70).tolist())[k % 2 * 777 :]) for k in range(12)]
    found = {r["media_id"]: r for r in media.match_recordings(spark.createDataFrame(list(enumerate(cells)), "media_id long, audio binary"), "media_id", "audio").collect()}
    assert found[0]["exact"] and found[0]["audit_recall"] == 1.0 and all(found[k]["component_id"] == k - k % 2 for k in range(12))


def test_excerpt_of_a_later_chorus(spark):
    """An exact excerpt is found though its longer part is also in the recording before, with another verse after it."""
    rnd = np.random.default_rng(12)
    chorus, (low, high) = rnd.integers(-18, 19, 60), rnd.integers(0, 12, 2)
    verses = [rnd.integers(k, k + 3, 40) for k in (low, high)]
    whole, excerpt = (wav(media.note_samples([*np.concatenate(v).tolist(), 18])) for v in ((chorus, verses[0], chorus, verses[1]), (chorus, verses[1])))
    df = spark.createDataFrame([(0, whole), (1, excerpt)], "media_id long, audio binary")
    assert {r["component_id"] for r in media.match_recordings(df, "media_id", "audio").collect()} == {0}


def test_still_parts_are_no_match():
    """Equal integers in a row fit anywhere; recordings that share nothing else aren't linked, whatever their overlap."""
    rnd = np.random.default_rng(2)
    tails = [rnd.integers(0, 1 << 32, 20).astype(np.uint32) for _ in range(2)]
    a, b = (np.concatenate([np.zeros(40, np.uint32), t]) for t in tails)
    assert not media.matches([a], [b]).any() and media.matches([a], [a[15:]]).all()
    assert media.matches([a, b, a[3:]]).tolist() == [[False, False, True], [False, False, False], [True, False, False]]


def test_fingerprint_boxes():
    """The integral image gives what summing rectangles gives."""
    image = np.abs(np.random.default_rng(1).normal(size=(30, 12)))

    def value(kind, y, h, w, at):
        box = image[at : at + w, y : y + h]
        inner = {
            1: box[:, h // 2 :],
            2: box[w // 2 :],
            4: box[:, h // 3 : h // 3 + max(1, h - 2 * (h // 3))],
            5: box[w // 3 : w // 3 + max(1, w - 2 * (w // 3))],
        }
        if kind == 0:
            part, rest = w * h / 12, box.sum()
        else:
            part = box[: w // 2, : h // 2].sum() + box[w // 2 :, h // 2 :].sum() if kind == 3 else inner[kind].sum()
            rest = box.sum() - part
        scale = max(1.0, w / 4)
        return math.log1p(part / scale) - math.log1p(max(rest, 0) / scale)

    want = []
    for at in range(30 - media.WINDOW + 1):
        out = 0
        for (kind, y, h, w), (low, middle, high) in zip(media.FILTERS, media.LEVELS.tolist(), strict=True):
            v = value(kind, y, h, w, at)
            out = out << 2 | (0 if v <= low else 1 if v <= middle else 3 if v <= high else 2)
        want.append(out)
    assert media.fingerprint(image).tolist() == want and len(media.fingerprint(image[:10])) == 0
    a = media.fingerprint(image)
    assert media.bit_error_rate(a, a[4:], 4) == (0.0, len(a) - 4) and media.bit_error_rate(a, a, 100) == (1.0, 0)


def test_odd_audio(spark, monkeypatch):
    """Cells that aren't 16-bit WAV have no integers; long files are read in blocks, as if at once."""
    import io
    import wave

    rnd = np.random.default_rng(7)
    loud = rnd.normal(scale=0.3, size=50_000)
    for rate in (4000, 3000, 11_025):
        monkeypatch.setattr(media, "_READ", 1 << 18)
        monkeypatch.setattr(media, "_FRAMES", 1 << 12)
        whole = media.wav_samples(wav(loud, rate))
        assert abs(len(whole) - len(loud) * media.RATE / rate) <= 2
        image = media.chroma(whole)
        monkeypatch.setattr(media, "_READ", 777)
        monkeypatch.setattr(media, "_FRAMES", 3)
        assert np.allclose(media.wav_samples(wav(loud, rate)), whole, atol=1e-5) and np.allclose(media.chroma(whole), image)
    eight = io.BytesIO()
    with wave.open(eight, "wb") as f:
        f.setnchannels(1)
        f.setsampwidth(1)
        f.setframerate(4000)
        f.writeframes(bytes(9000))
    rows = [(0, b""), (1, b"RIFF"), (2, b"no audio at all"), (3, eight.getvalue()), (4, wav(loud)[:30_001]), (5, wav(loud))]
    got = {r["media_id"]: r for r in media.match_recordings(spark.createDataFrame(rows, "media_id long, audio binary"), "media_id", "audio").collect()}
    assert [got[i]["n_prints"] for i in range(4)] == [0] * 4 and 0 < got[4]["n_prints"] < got[5]["n_prints"]
    assert [got[i]["component_id"] for i in range(4)] == [0, 1, 2, 3]


# ---------------------------------------------------------------- 7 vectors


def test_vectors(spark):
    rnd = np.random.default_rng(6)
    rows = []
    for i in range(300):
        rows.append((i, rnd.normal(size=16).round(4).tolist(), int(i % 2)))
    base = rnd.normal(size=16)
    for i in range(300, 500):  # one tight group
        rows.append((i, (base + rnd.normal(scale=0.08, size=16)).tolist(), 1))
    for i in range(500, 540):  # copies
        rows.append((i, rows[3][1], 1))
    rows += [(600, None, 1), (601, [0.0] * 16, 1), (602, [float("nan")] + [1.0] * 15, 1), (603, [None] + [1.0] * 15, 1), (604, rows[3][1], None), (605, [1.0, 2.0], 1), (606, [], 1), (None, rows[3][1], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("id", F.lit("clash"))
    good = [(i, np.array(v, np.float32).astype(float), y) for i, v, y in rows if i is not None and y is not None and v and len(v) == 16 and None not in v and np.isfinite(v).all() and np.any(v)]
    x = np.stack([v / np.linalg.norm(v) for _, v, _ in good])
    linked = (x @ x.T >= 0.93) & (np.array([y for *_, y in good])[:, None] == np.array([y for *_, y in good])[None])
    np.fill_diagonal(linked, False)
    ids = np.array([i for i, *_ in good])
    part = ids.copy()
    while True:
        new = np.minimum(part, np.where(linked, part[None], 10**9).min(axis=1))
        if (new == part).all():
            break
        part = new
    got = {r["vec_id"]: r for r in embed_dedup.near_duplicate_vectors(df).collect()}
    links = {i: int(n) for i, n in zip(ids, linked.sum(axis=1), strict=True)}
    assert {i: got[i]["n_links"] for i in links} == links
    assert {i: got[i]["component_id"] for i in links} == dict(zip(ids.tolist(), part.tolist(), strict=True))
    for i in (600, 601, 602, 603, 604, 605, 606):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)
    assert got[None]["component_id"] is None and embed_dedup.near_duplicate_vectors(df.limit(0)).count() == 0


def lone_pairs(spark, monkeypatch):
    """Isolated pairs just within range over many small shards: (which are linked, rows by id)."""
    monkeypatch.setattr(embed_dedup, "SHARD", 60)
    monkeypatch.setattr(embed_dedup, "BLOCK", 50, raising=False)
    rnd = np.random.default_rng(12)
    x = rnd.normal(size=(900, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    away = rnd.normal(size=(300, 16))
    away -= (away * x[:300]).sum(axis=1, keepdims=True) * x[:300]
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    x = np.concatenate([x, 0.94 * x[:300] + np.sqrt(1 - 0.94**2) * away, x[:5]])  # pairs, and copies of a few
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    close = x @ x.T >= 0.93
    np.fill_diagonal(close, False)
    return close, {r["vec_id"]: r for r in embed_dedup.near_duplicate_vectors(df).collect()}


def test_vector_pairs_across_shards(spark, monkeypatch):
    """Pairs are joined wherever the borders of shards and blocks run."""
    close, got = lone_pairs(spark, monkeypatch)
    apart = [(i, j) for i, j in np.argwhere(close).tolist() if got[i]["component_id"] != got[j]["component_id"]]
    assert not apart, f"{len(apart)} of {close.sum()}"
    assert all(0.9 <= r["audit_recall"] <= 1.0 for r in got.values())


def test_range_search_reaches_nodes_without_edges_into_them():
    """Node 2 has an edge to the crowd and none from it, and node 4 hangs on node 3, just outside the range."""
    angles = np.radians([0, 10, 5, 22, 20.5, 120])
    x = np.stack([np.cos(angles), np.sin(angles)], axis=1).astype(np.float32)
    graph = np.array([[1, -1], [0, 3], [0, -1], [1, 4], [-1, -1], [0, -1]])
    children = embed_dedup.backwards(graph, (np.zeros(7, np.int64), np.zeros(0, np.int64)))
    _, node = embed_dedup.range_search(x, graph, children, 5, x[:1], 2, float(np.cos(np.radians(21))), 0.02)
    assert sorted(node.tolist()) == [0, 1, 2, 4]


def test_vector_links_count_at_both_ends(spark, monkeypatch):
    close, got = lone_pairs(spark, monkeypatch)
    wrong = [i for i in got if got[i]["n_links"] != close[i].sum()]
    assert not wrong, f"{len(wrong)} of {len(got)}"


# ---------------------------------------------------------------- 9 near copies


def brute_components(rows):
    sets = {}
    for i, t, *_ in rows:
        if i is not None:
            w = words(t)
            sets.setdefault(i, []).append(frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and any(x and y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b]):
                a_, b_ = find(a), find(b)
                parent[max(a_, b_)] = min(a_, b_)
    return {i: find(i) for i in ids}, {i: Counter(map(len, s)) for i, s in sets.items()}


def test_near_copies_of_odd_texts(odd, no_docs):
    df, rows = odd
    part, sizes = brute_components(rows)
    got = minhash.near_duplicates(df.withColumn("band", F.lit(1))).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None
        else:
            assert r["component_id"] == part[r["doc_id"]] and r["kept"] == (part[r["doc_id"]] == r["doc_id"]) and r["n_shingles"] in sizes[r["doc_id"]]
    assert minhash.near_duplicates(no_docs).count() == 0


def edited_copies(rnd, n=150):
    """Rows (id, text): edited copies of one text, many beyond the threshold of one another, and a chain of them."""
    base = [f"w{rnd.randrange(500)}" for _ in range(80)]
    rows = []
    for i in range(n):
        w = list(base)
        for _ in range(rnd.randrange(1, 6)):
            w[rnd.randrange(len(w))] = f"e{rnd.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    chain = list(base)
    for i in range(n, n + 20):  # each is near the one before, few are near the first
        chain[(7 * i) % 80] = f"c{i}"
        rows.append((i, " ".join(chain)))
    return rows


@pytest.mark.parametrize(("docs", "few", "paired"), [(2000, 8, 32), (25, 0, 2)])
def test_near_copies_in_large_groups(spark, monkeypatch, docs, few, paired):
    """Blocks of any size, with rounds of leads and without, and bands compared as pairs or as blocks."""
    monkeypatch.setattr(minhash, "BLOCK_DOCS", docs)
    monkeypatch.setattr(minhash, "FEW_BLOCK_PAIRS", few)
    monkeypatch.setattr(minhash, "PAIRED", paired)
    monkeypatch.setattr(minhash, "LEADS", 6)
    rows = edited_copies(random.Random(12))
    part, _ = brute_components(rows)
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == part and len(set(part.values())) > 3


def test_blocks_are_bounded(spark, monkeypatch):
    """40,000 short sets of one group make blocks of some BLOCK_DOCS, and rows in proportion to the members."""
    members = spark.range(40_000).selectExpr("7L as g", "id", "4L as n", "id % 2 = 0 as near")
    sizes = minhash._block_counts(members)
    assert sizes.first().asDict() == {"g": 7, "open_docs": 20_000, "open_blocks": 40, "near_blocks": 40}
    sets = members.selectExpr("id", "unhex(repeat(lpad(hex(id), 16, '0'), 4)) as shingles")
    blocks = minhash._packed_blocks(members, sizes, sets)
    most, rows, docs = blocks.agg(F.max(F.length("sizes") / 8), F.count("*"), F.sum(F.length("ids") / 8)).first()
    assert rows == 80 and docs == 40_000 and most < 1.3 * minhash.BLOCK_DOCS


def test_common_counts():
    rnd = np.random.default_rng(9)
    left, right = ([np.unique(rnd.integers(0, 9000, rnd.integers(0, 4000)).astype(np.uint64)) for _ in range(7)] for _ in range(2))
    flat = [(np.array([len(s) for s in side]), np.concatenate(side)) for side in (left, right)]
    assert (minhash.common_counts(*flat) == [[len(np.intersect1d(a, b)) for b in right] for a in left]).all()


def test_sketches_estimate():
    rnd = np.random.default_rng(4)
    with np.errstate(over="ignore"):
        pool = np.unique(minhash.mix(rnd.integers(0, 2**62, 4000).astype(np.uint64)))
    guesses, truths = [], []
    for shared in (0, 300, 600, 900):
        a, b = np.sort(pool[:1000]), np.sort(np.concatenate([pool[:shared], pool[1000 : 2000 - shared]]))
        ra, rb = (minhash.sketch(s, np.array([0, len(s)])) for s in (a, b))
        guesses.append(minhash.estimated_similarity(ra, rb, np.array([len(a)]), np.array([len(b)]))[0][0])
        truths.append(shared / (2000 - shared))
    assert np.abs(np.array(guesses) - truths).max() < 0.12


# ---------------------------------------------------------------- 10 language model


def plain_scores(rows, order):
    """(doc_id, tokens, known tokens, training tokens, base score, score) of each row, by dictionaries; and the chances."""
    texts = [(i, ["<s>", *words(t), "</s>"]) for i, t, *_ in rows]
    train = [t for i, t in texts if i is not None and zlib.crc32(str(i).encode()) % 7 != 2]
    count = {k: Counter(tuple(t[i - k + 1 : i + 1]) for t in train for i in range(max(k - 1, 1), len(t))) for k in range(1, order + 1)}
    value = {order: count[order]}
    for k in range(1, order):  # different tokens before a gram; its count where it starts a text
        value[k] = Counter(g[1:] for g in count[k + 1])
        for g, c in count[k].items():
            if g[0] == "<s>":
                value[k][g] = c
    d = {k: ngram_lm.discounts([sum(c == n for c in value[k].values()) for n in (1, 2, 3, 4)]) for k in value}
    total, spare = defaultdict(int), defaultdict(float)
    for k in value:
        for g, c in value[k].items():
            total[g[:-1]] += c
            spare[g[:-1]] += d[k][min(c, 3)]
    v = len(count[1])

    def chance(g):
        c, below = value[len(g)][g], chance(g[1:]) if len(g) > 1 else 1 / (v + 1)
        return (max(c - d[len(g)][min(c, 3)], 0) + spare[g[:-1]] * below) / total[g[:-1]] if total[g[:-1]] else below

    n = sum(count[1].values())
    out = Counter()
    for i, t in texts:
        score = sum(math.log10(chance(tuple(t[max(0, j - order + 1) : j + 1]))) for j in range(1, len(t)))
        base = sum(math.log10((count[1][w,] + 1) / (n + v + 1)) for w in t[1:])
        out[i, len(t) - 1, sum(count[1][w,] > 0 for w in t[1:]), n, round(base, 4), round(score, 4)] += 1
    return out, chance, [w for w, in count[1]]


@pytest.mark.parametrize(("order", "range_bytes"), [(2, 64 << 20), (3, 2000), (4, 64 << 20)])
def test_language_model(odd, no_docs, monkeypatch, order, range_bytes):
    """Every probability against dictionaries, with more ranges than may be open; chances sum to one."""
    monkeypatch.setattr(ngram_lm, "RANGE_BYTES", range_bytes)
    monkeypatch.setattr(ngram_lm, "MOST_OPEN", 2)
    df, rows = odd
    expected, chance, names = plain_scores(rows, order)
    found = ngram_lm.score_texts(df, order=order).collect()
    assert Counter((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4), round(r["score"], 4)) for r in found) == expected
    for before in (("<s>",), ("uno",), ("uno", "dos")[: order - 1]):
        assert sum(chance((*before, w)) for w in [*names, "?"]) == pytest.approx(1)
    if order == 3:
        assert ngram_lm.score_texts(no_docs).count() == 0


def test_model_files_hold_large_counts_and_must_be_there(tmp_path):
    import pyarrow as pa

    rnd = np.random.default_rng(5)
    keys = np.unique(rnd.integers(0, 1 << 63, 5000).astype(np.uint64))
    counts = rnd.choice([1, 2, 254, 255, 100_000, 1 << 40], len(keys)).astype(np.int64)
    model = ngram_lm.Model(str(tmp_path), 2)
    table = pa.Table.from_batches([ngram_lm._ranges(0, keys, counts)])
    made = ngram_lm._write_range(str(tmp_path), 2, 0, True, False)(table).to_pylist()
    model.add(2, 0, made)
    asked = np.unique(np.concatenate([keys, rnd.integers(0, 1 << 63, 3000).astype(np.uint64)]))
    want = dict(zip(keys.tolist(), counts.tolist(), strict=True))
    assert ngram_lm.Level(model, 2).look_up(asked, ("count",))[0].tolist() == [want.get(k, 0) for k in asked.tolist()]
    model.folder = str(tmp_path / "elsewhere")
    with pytest.raises(FileNotFoundError):
        ngram_lm.Level(model, 2).look_up(asked, ("count",))
