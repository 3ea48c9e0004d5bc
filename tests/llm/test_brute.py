"""Operators against brute-force versions, libraries and exact facts."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import as_docs, prose, words
from pyspark.sql import functions as F

from regiostat.llm import decontamination, html_extraction, lm_scoring, mixing, near_duplicates, pii, quality_rules, secret_scan, token_counts, toxicity
from regiostat.llm.components import components


def test_token_counts_match_the_library(spark, odd_rows):
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = [r[1] or "" for r in odd_rows] + ["a<|endoftext|>b<|endoftext|>", "don't  I'LL ½²३ 中文 \x1c\x85\n\n x", "ab" * 5000, "  　x "]
    got = {r.doc_id: r.n_tokens for r in token_counts.token_counts(as_docs(spark, [(i, t) for i, t in enumerate(texts)]), path).collect()}
    want = [len(e.ids) for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert [got[i] for i in range(len(texts))] == want
    v = token_counts.Vocabulary(path)
    for t in texts:
        ids = [v.byte_id[b] for b in t[:300].encode()]
        assert v._merge_long(list(ids)) == v._merge_short(list(ids))


def quality_brute(t):
    ws = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    tri, marked = Counter(tuple(ws[i:i + 3]) for i in range(len(ws) - 2)), set()
    for i in range(len(ws) - 2):
        if tri[tuple(ws[i:i + 3])] > 1:
            marked |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in (t or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(ws), sum(map(len, ws)), sum((t or "").count(s) for s in "#*$%&|<>"), dup, len(marked)


def test_quality_counts_and_bands(spark, odd_rows):
    noise = "".join(random.Random(3).choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/ ") for _ in range(20_000))
    rows = [*odd_rows, (20, "x y\n\nx y\n #$ \nx y \nx y"), (21, "one two three four " * 200), (22, noise), (23, "\n".join(prose(i % 9, 7) for i in range(400)))]
    got = quality_rules.quality(as_docs(spark, rows)).collect()
    for r in got:
        text = next(x[1] for x in rows if x[0] == r.doc_id and (r.doc_id is not None or (x[1] is None) == (r.n_words == 0)))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == quality_brute(text)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    kept = {r.doc_id: r.kept for r in got}
    assert kept[1] and kept[6] and not kept[21] and not kept[22]


def decon_brute(docs, items):
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    win = defaultdict(set)
    for i, t in items:
        w = words(t, word)
        for k in range(max(1, len(w) - 9) if w else 0):
            win[tuple(w[k:k + 10])].add(i)
    out = {}
    for i, t in docs:
        w, hit, its = words(t, word), set(), set()
        for n in {len(x) for x in win}:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k:k + n])) in win:
                    hit |= set(range(k, k + n))
                    its |= win[x]
        out[i] = (len(w), len(hit), sorted(map(str, its)))
    return out


@pytest.mark.parametrize("block_words", [4_000_000, 60])
def test_decontamination(spark, block_words):
    rng = random.Random(1)
    items = [(i, prose(i, rng.randint(1, 40))) for i in range(30)] + [(30, "th"), (31, "Er, On"), (5, prose(5, 12)), (32, None)]
    docs = [(100, None), (101, ""), (102, "th")]
    for i in range(60):
        w = prose(500 + i, rng.randint(5, 200)).split()
        for _ in range(rng.randint(0, 3)):
            src = (items[rng.randrange(30)][1] or "").split()
            a = rng.randrange(len(src))
            w[rng.randrange(len(w)):0] = src[a:a + rng.randint(5, 25)]
        docs.append((i, " ".join(x.upper() if rng.random() < 0.2 else x + rng.choice(["", ",", "."]) for x in w)))
    got = decontamination.decontaminate(as_docs(spark, docs), spark.createDataFrame(items, "item_id long, text string"), block_words=block_words).collect()
    want = decon_brute(docs, items)
    assert len(got) == len(docs)
    for r in got:
        assert (r.n_words, r.n_hit, list(r["items"])) == want[r.doc_id], r.doc_id


def test_winnowing_guarantee():
    rng = np.random.default_rng(0)
    for _ in range(50):
        h = rng.integers(0, 50, 60).astype(np.uint64)
        kept = set(decontamination.winnow(h, np.zeros(60, np.int64), 6).tolist())
        for i in range(55):
            w = h[i:i + 6]
            assert i + max(j for j in range(6) if w[j] == w.min()) in kept


def groups_brute(rows, n_words, percent=80):
    sets, parent = {}, {}
    for i, t in rows:
        w = words(t)
        sets[i] = {tuple(w[k:k + n_words]) for k in range(len(w) - n_words + 1)} if len(w) >= n_words else ({tuple(w)} if w else set())
        parent[i] = i

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_near_duplicates_against_all_pairs(spark):
    rng = random.Random(4)
    rows = []
    for g in range(6):  # families of near copies around a base that may be missing, plus exact copies
        base = prose(g, 150).split()
        for _ in range(40 if g else 90):
            w = list(base)
            for _ in range(rng.randint(0, 9)):
                w[rng.randrange(len(w))] = f"w{rng.randrange(10 ** 6)}"
            rows.append((len(rows), " ".join(w)))
    rows += [(1000 + k, rows[k * 7][1].upper()) for k in range(20)] + [(2000, "a b"), (2001, "A  b"), (2002, "a b c"), (2003, None)]
    got = near_duplicates.near_duplicates(as_docs(spark, rows), words=4).collect()
    want = groups_brute(rows, 4)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_components_on_paths(spark):
    links = [(i, i + 1) for i in range(200)] + [(i + 1, i) for i in range(300, 400)] + [(500, 500)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 201)}, **{i: 300 for i in range(301, 401)}}


def test_odd_sketch_estimate():
    assert near_duplicates.most_bits(1.0) == 0
    assert near_duplicates.most_bits(0.55) > near_duplicates.most_bits(0.8) > 0


def test_toxicity_learns_terms_prefixes_and_pairs(spark):
    rng, rows, labels = random.Random(2), [], []
    for i in range(1500):
        w, y = prose(i, 60).split(), int(rng.random() < 0.2)
        if y:
            w[rng.randrange(60)] = rng.choice(["scumbag", f"lowei{rng.choice('abcdefgh')}{rng.randrange(99)}"])
        rows.append((i, " ".join(w)))
        labels.append((i, y))
    docs, marks = as_docs(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    machine = toxicity.train(docs, marks, learn=F.col("doc_id") % 3 != 1)
    got = {r.doc_id: r.score for r in toxicity.score(docs, machine).collect()}
    held = [(y, got[i] >= 0.7) for i, y in labels if i % 3 == 1]
    assert np.mean([a == b for a, b in held]) > 0.98
    assert all(0 <= s <= 1 for s in got.values())
    # a pair that only means something together
    x = np.array([[0, 0], [0, 1], [1, 0], [1, 1]] * 200)
    doc, term = np.nonzero(x)
    m = toxicity.fit_machine(x.prod(axis=1).astype(float), doc, term + 5)
    s = toxicity._sigmoid(m.margin(4, *[np.array(v) for v in ([1, 2, 3, 3], [6, 5, 5, 6])]))
    assert s[3] > 0.9 and s[:3].max() < 0.2


def test_toxicity_learns_labels_that_only_a_pair_of_words_decides(spark):
    rng, rows, labels = random.Random(4), [], []
    for i in range(4000):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        w = prose(i, 40).split() + ["alphaword"] * a + ["betaword"] * b
        rng.shuffle(w)
        rows.append((i, " ".join(w)))
        labels.append((i, int(a == b)))
    docs, marks = as_docs(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    machine = toxicity.train(docs, marks, learn=F.col("doc_id") % 3 != 1)
    got = {r.doc_id: r.score for r in toxicity.score(docs, machine).collect()}
    assert np.mean([(got[i] >= 0.5) == (y == 1) for i, y in labels if i % 3 == 1]) > 0.95


def test_machine_margin_is_the_plain_sum_over_pairs():
    rng = np.random.default_rng(9)
    place = np.full(1 << toxicity.BITS, -1, np.int32)
    chosen = rng.choice(1 << toxicity.BITS, 30, replace=False)
    place[chosen] = np.arange(30)
    weight = np.zeros(1 << toxicity.BITS)
    weight[chosen] = rng.normal(size=30)
    m = toxicity.Machine(0.3, weight, rng.normal(size=(30, 8)), place)
    texts = [rng.choice(chosen, k, replace=False) for k in (0, 1, 2, 9, 30)]
    doc, term = np.repeat(np.arange(5), [len(t) for t in texts]), np.concatenate(texts)
    for got, t in zip(m.margin(5, doc, term), texts):
        want = 0.3 + sum(weight[i] for i in t) + sum(m.factor[place[i]] @ m.factor[place[j]] for a, i in enumerate(t) for j in t[a + 1:])
        assert got == pytest.approx(want)


def test_separating_words_against_all_pairs():
    rng = np.random.default_rng(2)
    rows = [np.unique(rng.integers(0, 60, 20)) for _ in range(600)]
    label = np.array([float((3 in r) and (7 in r) or rng.random() < 0.2) for r in rows])
    found = set()
    share = label.mean()
    for a in range(60):
        for b in range(a + 1, 60):
            y = [l for l, r in zip(label, rows) if a in r and b in r]
            if len(y) >= 8 and abs(sum(y) - share * len(y)) / (len(y) * share * (1 - share)) ** 0.5 >= 6:
                found |= {a, b}
    assert found == set(toxicity.separating_words(label, rows, 8, 6.0).tolist()) == {3, 7}


def test_secret_verdicts_by_repositories_owners_and_documents(spark):
    key = "api_key=Aa0Bb1Cc2Dd3Ee4Ff5{}"
    rows = [(i, f"{prose(i, 10)} {key.format('many')}", ["en", "de", "fr"][i % 3], "s1") for i in range(12)]       # three repositories of one owner
    rows += [(100 + i, f"{prose(i, 10)} {key.format('copy')}", "en", "s1") for i in range(50)]                      # one repository, fifty documents
    rows += [(200 + i, f"{prose(i, 10)} {key.format('both')}", "en", f"s{i}") for i in range(2)]                    # two owners
    rows += [(300, f"x {key.format('own')}", "en", "s9"), (301, "y password=aaaaaaaaaaaa", "en", "s9")]
    got = {r.doc_id: [x.v for x in r.spans] for r in secret_scan.scan(as_docs(spark, rows)).collect()}
    assert {got[i][0] for i in range(12)} == {got[100 + i][0] for i in range(50)} == {"example"}
    assert got[200] == got[201] == got[300] == ["live"] and got[301] == ["unclear"]


def test_a_term_far_from_the_entity_discloses_it_and_is_marked_everywhere(spark):
    rows = [(k, f"Zaphodius {prose(k, 400)} zaphodius {prose(60 + k, 300)} mail bob@ex.org") for k in range(6)] + [(100 + k, prose(100 + k, 60)) for k in range(60)]
    rows.append((500, f"zaphodiuses {prose(5, 20)}"))
    got = {r.doc_id: r for r in pii.scan(as_docs(spark, rows), with_text=True).collect()}
    for k in range(6):
        assert "aphodius" not in got[k].text and sum(x.k == pii.TERM for x in got[k].spans) >= 2
    assert "zaphodiuses" in got[500].text


def test_long_texts_with_many_entities(spark):
    import time
    took = []
    for n in (2_000, 20_000):
        rows = [(1, " ".join(f"user{i}@ex{i % 7}.org word" for i in range(n))), (2, "a@b.cd")]
        start = time.time()
        got = {r.doc_id: r for r in pii.digest(pii.scan(as_docs(spark, rows))).collect()}
        took.append(time.time() - start)
        assert got[1].n_email == n
    assert took[1] < 12 * took[0] + 5


def test_lm_base_scores_and_probabilities_that_add_up(spark):
    rows = [(i, prose(i, 50 + i)) for i in range(60)] + [(60, None), (61, "unseen1 unseen2")]
    s = lm_scoring.Settings(block_tokens=700, bucket_tokens=2_000, max_contexts=64)
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2 or i == 61
    learn = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2) & (F.col("doc_id") != 61)
    got = {r.doc_id: r for r in lm_scoring.lm_scores(as_docs(spark, rows), learn, s).collect()}
    tokens = {i: [*words(t), "</s>"] for i, t in rows}
    count = Counter(w for i, t in tokens.items() if not held(i) for w in t)
    n, v = sum(count.values()), len(count)
    for i, t in tokens.items():
        assert got[i].n_tokens == len(t) and got[i].train_tokens == n and got[i].n_known == sum(count[w] > 0 for w in t)
        assert math.isclose(got[i].base_score, sum(math.log10((count[w] + 1) / (n + v + 1)) for w in t), rel_tol=1e-9)
    # one-word texts score P(w | start) + P(end | w); the first over all words and an unknown one is 1
    vocabulary = sorted(w for w in count if w != "</s>")
    probe = as_docs(spark, [(i, t) for i, t in rows if not held(i)] + [(10_000 + k, w) for k, w in enumerate(vocabulary)] + [(9_999, "unknown0"), (9_998, "")])
    two = {r.doc_id: r.score for r in lm_scoring.lm_scores(probe, F.col("doc_id") < 9_000, s).collect()}
    pairs = as_docs(spark, [(i, t) for i, t in rows if not held(i)] + [(20_000 + k, f"{w} {w2}") for k, (w, w2) in enumerate((vocabulary[3], x) for x in [*vocabulary, "unknown0"])])
    assert all(x < 0 for x in two.values())
    after = {r.doc_id: r.score for r in lm_scoring.lm_scores(pairs, F.col("doc_id") < 9_000, s).collect()}
    # P(w3 w) P(end | w) summed over w with P(end | w) = two[w] / P(w | start) cannot exceed one
    assert sum(10 ** after[20_000 + k] for k in range(len(vocabulary) + 1)) < 1


def test_seating_is_reproducible_and_bounded():
    s = lm_scoring.Settings()
    c = np.array([0, 1, 2, 5, 40, 100_000])
    seat = lambda: (lambda z, rng: (z.sweep(rng, np.full(6, 0.5), 0.8), z.tables(rng, np.full(6, 0.5), 0.8))[1])(lm_scoring.Seating(c, s.seats), np.random.default_rng(1))
    t = seat()
    assert (t == seat()).all() and (t <= c).all() and (t[1:] >= 1).all()


def test_pack_round_trip():
    arrays = [np.arange(300), np.zeros(0, np.int64), np.array([2 ** 40, 1])]
    back = lm_scoring.unpack(lm_scoring.pack(*arrays))
    assert all((a == b).all() for a, b in zip(arrays, back))


@pytest.mark.parametrize("name", ["secret", "mix", "pii"])
def test_against_duckdb(spark, odd_rows, name, tmp_path):
    rows = [r for r in odd_rows if r[0] is not None] + [(200 + k, f"{prose(k, 30 + 9 * k)} password=aaaa1111bbbb2222cccc bob@ex.org {prose(3, 12)} Zz9Yy8Xx7Ww6Vv5Uu4Tt{k}", "en", f"s{k % 5}") for k in range(20)]
    docs = as_docs(spark, rows)
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text", "lang", "source").toPandas())
    spark_df, sql = {"secret": lambda: (secret_scan.digest(secret_scan.scan(docs)), secret_scan.oracle()), "mix": lambda: (mixing.mix(docs), mixing.oracle()),
                     "pii": lambda: (pii.digest(pii.scan(docs)), pii.oracle())}[name]()
    got = spark_df.toPandas()[sorted(spark_df.columns)]
    want = con.sql(sql).df()[sorted(spark_df.columns)]
    key = lambda df: sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.itertuples(index=False))
    assert key(got) == key(want)
    if name == "mix":
        per = docs.join(spark.createDataFrame(got), "doc_id").groupBy("source").agg(F.max("target").alias("t"), F.sum("taken").alias("n")).collect()
        assert sum(r.t for r in per) == pytest.approx(got["size"].sum())
        assert (got.taken <= 3 * got["size"]).all()
    if name == "pii":
        assert got.n_term.sum() > 0 and got.n_email.sum() >= 20


def test_sanitised_text(spark):
    rows = [(k, f"{prose(k, 20)} nickname bob@ex.org {prose(50 + k, 20)}") for k in range(6)]
    others = [(100 + k, prose(100 + k, 40)) for k in range(30)]
    got = {r.doc_id: r.text for r in pii.scan(as_docs(spark, rows + others), with_text=True).collect()}
    assert all("[EMAIL]" in got[k] and "bob@" not in got[k] and "nickname" not in got[k] for k in range(6))
    assert all(got[i] == t for i, t in others)


LONG = "This is a long paragraph of article text, with several sentences in it. It goes on, so that it looks like prose. And one more sentence."
PAGES = {
    f'<body><div class="menu"><a href=x>Home</a></div><div id="content"><h1>Head</h1><p>{LONG}<p>Short &amp; sweet.</div><div class="sidebar">{LONG}</div>': f"Head {LONG} Short & sweet.",
    f'<main><article><h1>H</h1><p>{LONG} <b>bold<br></b>end<script>var a="</p>"</script></p><aside>{LONG}</aside></article><section id="comments"><p>{LONG}</p></section></main>': f"H {LONG} bold end",
    f'<body><div class="cookie-notice"><p>{LONG}</p><button>OK</button></div><main><p>{LONG}</p><form>{LONG}</form><!-- x --></main><footer>{LONG}</footer>': LONG,
}


def test_html_extraction(spark):
    article = "<html><body><nav><ul><li><a href=a>one</a></li></ul></nav><article><h1>T</h1><p>{}</p></article><div class=ad>Buy</div><footer>&copy; x</footer></body></html>"
    labelled = [article.format(LONG + f" Number {i}.") for i in range(40)]
    pages = spark.createDataFrame([(i, "u", h) for i, h in enumerate([*labelled, *PAGES])], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_extraction.extract(pages, html_extraction.train(pages)).collect()}
    assert [got[40 + k] for k in range(len(PAGES))] == list(PAGES.values())
    assert all(got[i] == f"T {LONG} Number {i}." for i in range(40))


def test_pages_whose_names_mislead_keep_their_article(spark):
    page = ('<html><body><nav><a href=x>Home</a></nav><article class="post-related"><h1>T{0}</h1><div class="message"><p>' + LONG + ' Number {0}.</p></div></article>'
            '<div class="sidebar"><p>' + LONG + '</p></div><footer>foot</footer></body></html>')
    pages = spark.createDataFrame([(i, "u", page.format(i)) for i in range(400)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_extraction.extract(pages, html_extraction.train(pages)).collect()}
    assert all(got[i] == f"T{i} {LONG} Number {i}." for i in range(400))
    # a few pages do not outweigh the prior
    few = html_extraction.train(pages.limit(2))
    assert abs(few.weight - html_extraction.train(pages.limit(0)).weight).max() < abs(html_extraction.train(pages).weight - html_extraction.train(pages.limit(0)).weight).max()


def test_labels_of_deep_pages_take_linear_time():
    import time
    from regiostat.llm.html_tree import read
    took = []
    for depth in (2_000, 16_000):
        nodes, _ = read("<article>" + "<div>" * depth + LONG, html_extraction.is_clutter)
        start = time.time()
        assert html_extraction.own_labels(nodes).count(html_extraction.CONTENT) == depth + 1
        took.append(time.time() - start)
    assert took[1] < 30 * took[0] + 0.5


def test_marginals_match_enumeration():
    rng = np.random.default_rng(5)
    parent, depth = np.array([-1, 0, 0, 1, 1, 2]), np.array([0, 1, 1, 2, 2, 2])
    u, pair = rng.normal(size=(6, 3)), rng.normal(size=(3, 3))
    total = np.zeros((6, 3))
    for state in np.ndindex(*[3] * 6):
        w = math.exp(sum(u[i, s] for i, s in enumerate(state)) + sum(pair[state[parent[i]], state[i]] for i in range(1, 6)))
        for i, s in enumerate(state):
            total[i, s] += w
    assert np.allclose(html_extraction.marginals(u, parent, depth, pair), total / total.sum(axis=1, keepdims=True))


def test_word_hashes():
    from regiostat.llm.textvec import Words, text_blocks
    texts = ["a b a", None, "", "Aé b\tb", "x" * 5000]
    seen, n = {}, 0
    for _, data, offsets in text_blocks(pa.array(texts), 4):
        w = Words(data, offsets)
        n += len(w.hashes)
        for k in range(len(w.hashes)):
            word = bytes(w.raw[w.starts[k]:w.ends[k]])
            assert seen.setdefault(word, w.hashes[k]) == w.hashes[k]
    assert n == 7 and len(set(seen.values())) == len(seen) == 4
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")


def base_spans(text, kinds):
    """Leftmost, non-overlapping matches per kind by the plain patterns."""
    return {name: [(m.start(), m.end()) for m in re.finditer(pattern, text) if keep(m)] for name, pattern, keep in kinds}


def luhn_ok(m):
    d = [int(c) for c in re.sub("[^0-9]", "", m.group(0))]
    return 13 <= len(d) <= 19 and sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(reversed(d))) % 10 == 0


SECRETS = [("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 12),
           ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 18), ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 16)]
PERSONAL = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
            ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m[0].split("."))),
            ("card", r"[0-9]([\x20-]?[0-9])+", luhn_ok),
            ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15)]


def random_texts(pieces, n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 30))) for _ in range(n)]


def test_base_secrets_against_plain_patterns(spark):
    pieces = ["token", "Secret", "api_key", "APIKEY", "passWD", "=", ":", " ", "  ", '"', "'", "abc123def456", "0123456789abcdef", "AKIA", "ABCDEFGHIJ1234", "x", "é", "-", "_", "\n", "K", "ſ"]
    rows = list(enumerate(random_texts(pieces, 600, 1)))
    got = {r.doc_id: r for r in secret_scan.scan(as_docs(spark, rows)).collect()}
    for i, t in rows:
        want = base_spans(t, SECRETS)
        for k, (name, _, _) in enumerate(SECRETS):
            assert sorted((x.s, x.e) for x in got[i].spans if x.k == k) == want[name], (t, name)


def test_base_personal_data_against_plain_patterns(spark):
    pieces = ["a", "b.c", "@", "@x.org", "_", ".", "..", "1", "25", "255", "300", "007", "+1", "+49 ", "(212) ", "555-0153", "4111111111111111", "4111 1111 1111 1111", "-", " ", "é", "\n", "%", "10.0.0.1"]
    rows = list(enumerate(random_texts(pieces, 600, 2)))
    got = {r.doc_id: r for r in pii.scan(as_docs(spark, rows)).collect()}
    for i, t in rows:
        want = base_spans(t, PERSONAL)
        for k, (name, _, _) in enumerate(PERSONAL):
            assert sorted((x.s, x.e) for x in got[i].spans if x.k == k) == want[name], (t, name)


def test_lm_rare_contexts_have_restaurants(spark):
    rows = [(i, f"{prose(i, 60)} seldom{i % 20} follower{i % 20} {prose(500 + i, 20)}") for i in range(80)]
    probes = [(1_000 + k, f"seldom{k} follower{k}") for k in range(20)] + [(2_000 + k, f"seldom{k} follower{(k + 1) % 20}") for k in range(20)]
    docs = as_docs(spark, rows + probes)
    few, many = ({r.doc_id: r.score for r in lm_scoring.lm_scores(docs, F.col("doc_id") < 1_000, lm_scoring.Settings(block_tokens=700, bucket_tokens=2_000, max_contexts=m)).collect()}
                 for m in (16, 1 << 14))
    # four of four times the follower came: far likelier than a word never seen there, whatever is broadcast
    for got in (few, many):
        assert sum(got[1_000 + k] - got[2_000 + k] for k in range(20)) / 20 > 1.5
    assert sum(abs(few[i] - many[i]) for i in few) < 0.02 * sum(abs(x) for x in many.values())


@pytest.mark.parametrize("c", [20, 100, 2_000, 100_000])
@pytest.mark.parametrize("share", [1e-4, 0.05, 0.25, 2.0])
def test_seating_of_later_customers_follows_the_rule(c, share):
    d, strength, a = 0.8, 2.0, max(share * c, 0.5)
    rows = 2_000 if c <= 2_000 else 60
    got = lm_scoring.Seating(np.full(rows, c), 16).tables(np.random.default_rng(3), np.full(rows, a), d)
    # one customer after the other, from the same 16 at one table
    rng, t = np.random.default_rng(4), np.ones(rows)
    for n in range(16, c):
        t += rng.random(rows) < a / (n - d * t + a)
    error = 5 * np.hypot(got.std(), t.std()) / rows ** 0.5
    assert abs(got.mean() - t.mean()) <= error + 0.005 * t.mean()
    score = lambda x: ((c - d * x) / (strength + c)).mean()
    assert abs(score(got) - score(t)) <= d * (error + 0.005 * t.mean()) / (strength + c)
