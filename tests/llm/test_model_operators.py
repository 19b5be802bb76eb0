"""Language model, decontamination, BPE, language ID, Jaccard join and HTML: brute force, round trips, held-out accuracy."""

import math
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import bpe, decontaminate, html_extract, jaccard_join, language_id, ngram_lm
from ledgerloom.llm.components import components
from ledgerloom.llm.elias_fano import EliasFano
from ledgerloom.llm.queries import VOCABULARY
from ledgerloom.llm.signature_tree import SignatureTree, bitmap, dual_join, folded
from ledgerloom.llm.text import WordHashes

DATA = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i % 4000}" for i in range(30_000))
ODD = [(1, None), (2, ""), (3, LONG), (4, "one"), (4, "one"), (None, "null id here"), (5, " \t\n")]


def frame(spark, rows, name="doc_id"):
    return spark.createDataFrame(rows, f"{name} bigint, text string").withColumn("score", F.lit("clash")).withColumn("key", F.lit(1))


@pytest.mark.parametrize("n, universe", [(0, 10), (1, 1), (5, 6), (1000, 50), (3000, 1 << 50), (500, (1 << 64) - 1)])
def test_elias_fano(n, universe):
    draw = np.random.default_rng(n)
    values = np.sort(draw.integers(0, universe, n, dtype=np.uint64))
    coded = EliasFano.of(values, universe)
    assert (coded.values(np.arange(n)) == values).all()
    wanted = np.concatenate([draw.integers(0, universe, 300, dtype=np.uint64), values])
    at, equal = coded.successor(wanted, np.zeros(len(wanted), np.int64), np.full(len(wanted), n))
    assert (at == np.searchsorted(values, wanted)).all() and (equal == np.isin(wanted, values)).all()


def test_language_model_against_counts(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    got = {r.doc_id: r for r in ngram_lm.score_documents(docs, strength=10.0).collect()}
    tokens = {r.doc_id: [*(r.text or "").encode().lower().split(), None] for r in docs.collect()}
    train = [t for i, t in tokens.items() if zlib.crc32(str(i).encode()) % 10]
    counts = Counter(w for t in train for w in t)
    pairs = Counter(p for t in train for p in zip(["begin", *t], t))
    total, types = sum(counts.values()), len(counts)
    for i, text in tokens.items():
        row = got[i]
        unigram = [(counts[w] + 0.1) / (total + 0.1 * (types + 1)) for w in text]
        model = [(pairs[c, w] + 10 * p) / ((len(train) if c == "begin" else counts[c]) + 10) for c, w, p in zip(["begin", *text], text, unigram)]
        assert (row.n_tokens, row.n_known, row.train_tokens) == (len(text), sum(counts[w] > 0 for w in text), total)
        assert row.base_score == pytest.approx(sum(map(math.log10, unigram)))
        assert abs(row.score - sum(map(math.log10, model))) <= 0.03 * len(text)
    held = [i for i in tokens if got[i].held_out]
    assert held and sum(got[i].score for i in held) > sum(got[i].base_score for i in held)


def test_language_model_odd_rows(spark):
    got = sorted((str(r.doc_id), r.n_tokens) for r in ngram_lm.score_documents(frame(spark, ODD)).collect())
    assert got == sorted([("1", 1), ("2", 1), ("3", 30_001), ("4", 2), ("4", 2), ("None", 4), ("5", 1)])
    assert ngram_lm.score_documents(frame(spark, [])).count() == 0


def test_each_bigram_is_looked_up_once(monkeypatch):
    asked, search = [], EliasFano.successor
    monkeypatch.setattr(EliasFano, "successor", lambda self, values, low, high: asked.append(len(values)) or search(self, values, low, high))
    word, end = np.uint64(100), ngram_lm.END
    row = {
        "docs": np.array([(1, 5), (2, 6)], [("id", "<i8"), ("text", "<u8")]), "trains": np.array([1, 0], "u1"), "words": np.array([end, word]),
        "counts": np.array([2, 1000], "<u4"), "contexts": np.array([7, 8] + [7] * 1000, "<u4"), "owners": np.array([0, 1] + [0] * 900 + [1] * 100, "<u2"),
    }
    totals = ngram_lm.Totals(901, 2, 1, np.zeros(0, np.uint64), np.zeros(0, np.int64))
    got = ngram_lm.score_shard(pa.table({c: [x.tobytes()] for c, x in row.items()}), totals, 50.0).to_pydict()
    assert (got["n_tokens"], got["n_known"], got["n_end"]) == ([901, 101], [901, 101], [1, 1])
    p = {w: math.log10((n + 0.1) / (901 + 0.1 * 3)) for w, n in (("end", 1), ("word", 900))}
    known, unknown = math.log10((1 + 50 * 10 ** p["end"]) / 51), p["end"] + math.log10(50 / 51)
    each = math.log10((900 + 50 * 10 ** p["word"]) / 950)
    assert got["score"] == pytest.approx([known + 900 * each, unknown + 100 * each], rel=1e-3)
    assert sum(asked) <= 5  # two words and three bigrams


def test_items_found_and_clean_documents_left(spark):
    draw = random.Random(2)
    words = [f"b{i}" for i in range(500)]
    items = [(i, " ".join(draw.choices(words, k=draw.randint(15, 50)))) for i in range(20)]
    rows, want = [], {}
    for i, text in items:
        parts = text.split()
        changed = list(parts)
        for at in draw.sample(range(len(parts)), int(0.2 * len(parts))):
            changed[at] = "zz"
        far = list(parts)
        for at in draw.sample(range(len(parts)), int(0.5 * len(parts))):
            far[at] = f"y{at}"
        for k, body in enumerate((parts, changed, far)):
            rows.append((10 * i + k, " ".join(draw.choices(["c", "d", "e"], k=40) + body + draw.choices(["c", "d", "e"], k=40)).upper()))
        want[10 * i], want[10 * i + 1] = (i, 0, 40), (i, int(0.2 * len(parts)), 40)
    bench = frame(spark, [*items, (98, None), (99, ""), (97, "x1 x2")], "item_id")
    got = {r.doc_id: (r.item_id, r.distance, r.start) for r in decontaminate.find_items(frame(spark, rows + ODD[:3]), bench).collect()}
    assert got == want
    assert decontaminate.drop_contaminated(frame(spark, rows), bench).count() == 20
    assert decontaminate.find_items(frame(spark, []), bench).count() == 0
    assert decontaminate.find_items(frame(spark, rows), bench.limit(0)).count() == 0
    assert sorted(str(r.doc_id) for r in decontaminate.drop_contaminated(frame(spark, ODD), bench).collect()) == sorted(str(i) for i, _ in ODD)


@pytest.mark.parametrize("around", [0, 40])
@pytest.mark.parametrize("kind", ["left out", "added", "mixed"])
def test_items_with_words_left_out_or_added(spark, kind, around):
    draw = random.Random(6)
    items = [(i, [f"b{draw.randint(0, 499)}" for _ in range(draw.randint(15, 50))]) for i in range(20)]
    rows, want = [], {}
    for i, parts in items:
        body, most = list(parts), int(0.2 * len(parts))
        places = draw.sample(range(1, len(parts) - 1), most)
        for k, at in enumerate(sorted(places, reverse=True)):
            body[at : at + 1] = [] if kind == "left out" or (kind == "mixed" and k % 2) else [body[at], f"z{at}"]
        rows.append((i, " ".join(draw.choices(["c", "d", "e"], k=around) + body + draw.choices(["c", "d", "e"], k=around))))
        want[i] = (i, most, around)
    bench = frame(spark, [(i, " ".join(parts)) for i, parts in items], "item_id")
    got = {r.doc_id: (r.item_id, r.distance, r.start) for r in decontaminate.find_items(frame(spark, rows), bench).collect()}
    assert {i: (item, start) for i, (item, _, start) in got.items()} == {i: (item, start) for i, (item, _, start) in want.items()}
    assert all(got[i][1] <= want[i][1] for i in want)
    assert kind == "mixed" or got == want


def test_best_match_is_the_nearest_run():
    draw = random.Random(1)
    for _ in range(200):
        item, text = draw.choices(range(4), k=draw.randint(1, 7)), draw.choices(range(4), k=draw.randint(0, 9))
        runs = [(decontaminate.edit_distance(item, text[a:b], 99), a) for a in range(len(text)) for b in range(a, len(text) + 1)]
        assert decontaminate.best_match(decontaminate.word_bits(item), len(item), text) == min([*runs, (len(item), len(text))])


def test_edit_distance():
    assert decontaminate.edit_distance(list("kitten"), list("sitting"), 5) == 3
    assert decontaminate.edit_distance(list("abc"), list("xyz"), 1) == 2
    assert decontaminate.edit_distance([], list("ab"), 3) == 2


def test_bpe_equals_the_library(spark):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(VOCABULARY)
    draw = random.Random(1)
    bits = ["a", "b", " ", "  ", "\n", "\t", "'s", "'ll", "é", "<|endoftext|>", "1", "٣", "!", "\u00a0", "\x1c", "\x85", "😀", "ก", "'S", "the", "\r\n"]
    texts = ["".join(draw.choices(bits, k=draw.randint(0, 25))) for _ in range(300)] + ["a" * 20_000, LONG, ""]
    rows = [*enumerate(texts), (None, None), (0, texts[0])]
    got = bpe.encode_documents(frame(spark, rows).withColumn("ids", F.lit("clash")), VOCABULARY).collect()
    assert len(got) == len(rows)
    for r in got:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == ids
        assert r.decoded == library.decode(ids, skip_special_tokens=False)
    assert bpe.digest_documents(frame(spark, []), VOCABULARY).count() == 0


def test_language_held_out_and_odd_rows(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    model = language_id.fit_languages(docs.where("doc_id % 4 <> 2").select("text", "lang"))
    got = language_id.predict_languages(docs.where("doc_id % 4 = 2"), model)
    right = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.min("score"), F.max("score")).first()
    assert right[0] > 0.97 and 0 <= right[1] <= right[2] <= 1
    odd = frame(spark, [*ODD, (7, "123 !?"), (8, "¿Qué?")])
    rows = {(r.doc_id, r.text): r for r in language_id.predict_languages(odd, model).collect()}
    assert len(rows) == 8 and rows[1, None].lang_pred == rows[7, "123 !?"].lang_pred == rows[2, ""].lang_pred == "und"
    assert rows[3, LONG].lang_pred in model.languages and rows[1, None].score == 0
    signs = frame(spark, [(1, "½ ²"), (2, "Ⅷ 12"), (3, "ª"), (4, "中文字"), (5, LONG * 3)])
    named = {r.doc_id: r.lang_pred for r in language_id.predict_languages(signs, model).collect()}
    assert named[1] == named[2] == "und" and "und" not in (named[3], named[4], named[5])
    nothing = language_id.fit_languages(docs.limit(0).select("text", "lang"))
    assert {r.lang_pred for r in language_id.predict_languages(odd, nothing).collect()} == {"und"}
    assert language_id.predict_languages(odd.limit(0), model).count() == 0


def test_language_scores_against_counts(spark, monkeypatch):
    """Batches of sparse rows give what counting one text's n-grams gives, also in pieces and small batches."""
    texts = ["aab ab", "Ba", "ünï cödé 中文", "x" * 700, "1 2", None, "b\ud800a"]
    docs = [("xx", "aabb ab"), ("yy", "bab ünï 中"), ("yy", "aaa xx"), ("zz", None)]
    model = language_id.fit_languages(spark.createDataFrame(docs, "lang string, text string"), orders=(1, 2), buckets=97)
    counts = {lang: Counter() for lang in ("xx", "yy")}

    def grams(text):
        return [b for found in language_id.text_buckets(text, (1, 2), 97) for b in found.tolist()]

    for lang, text in docs[:3]:
        counts[lang].update(grams(text))
    for piece, batch in ((1 << 18, 1 << 20), (5, 7)):
        monkeypatch.setattr(language_id, "PIECE", piece)
        monkeypatch.setattr(language_id, "BATCH", batch)
        langs, scores = language_id._best(model, texts)
        for text, lang, score in zip(texts, langs, scores):
            if text is None or not any(map(str.isalpha, text)):
                assert (lang, score) == ("und", 0.0)
                continue
            joint = {x: math.log(n / 3) + sum(math.log((counts[x][b] + 0.5) / (sum(counts[x].values()) + 0.5 * 97)) for b in grams(text)) for x, n in (("xx", 1), ("yy", 2))}
            best = max(joint, key=joint.get)
            assert lang == best and score == pytest.approx(1 / sum(math.exp(v - joint[best]) for v in joint.values()), abs=1e-4)


def brute_components(rows, size=5, percent=80):
    sets = []
    for i, text in rows:
        w = (text or "").encode().lower().split()
        sets.append((i, frozenset(tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))) if w else frozenset()))
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                parent[root(a)] = root(b)
    least = {}
    for a, (i, _) in enumerate(sets):
        least[root(a)] = min(least.get(root(a), i), i)
    return {i: (len(s), least[root(a)]) for a, (i, s) in enumerate(sets)}


def test_jaccard_components(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "CELL", 4)  # several cells for a key
    draw = random.Random(4)
    rows, n = [], 0
    for family in range(6):
        base = [f"f{family}x{draw.randint(0, 200)}" for _ in range(draw.choice([3, 6, 30, 120]))]
        for _ in range(14):
            text = list(base)
            for _ in range(draw.randint(0, max(1, len(base) // 40))):
                text[draw.randrange(len(text))] = f"n{n}"
            rows.append((n, " ".join(text)))
            n += 1
    rows += [(1000 + i, " ".join([f"own{i}w{k}" for k in range(60)] + ["a common passage of eight words in all"])) for i in range(15)]
    rows += [(2000, ""), (2001, None), (2002, "x"), (2003, "X"), (2004, LONG), (2005, LONG + " end")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(frame(spark, rows)).collect()}
    assert got == brute_components(rows)


def test_jaccard_odd_rows(spark):
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in jaccard_join.jaccard_components(frame(spark, ODD)).collect())
    assert [x[0] for x in got] == sorted(str(i) for i, _ in ODD)
    assert got.count(("4", 1, "4")) == 2 and ("1", 0, "1") in got
    assert jaccard_join.jaccard_components(frame(spark, [])).count() == 0


def test_common_shingles_are_counted_in_all_documents(spark):
    n, passage = 8200, "a passage of five"
    odd = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 1  # what a sample of every second document by hash would not see
    docs = spark.range(n).withColumnRenamed("id", "doc_id").withColumn("text", F.when(odd & (F.col("doc_id") < 100), passage).otherwise(F.concat(F.lit("own"), "doc_id")))
    want = jaccard_join.token_set(passage, 5, WordHashes())
    assert jaccard_join.common_shingles(docs, 5, n).tolist() == want.tolist()


def test_lossy_counts_miss_nothing_common(monkeypatch):
    monkeypatch.setattr(jaccard_join, "COMMON", 10)
    monkeypatch.setattr(jaccard_join, "COUNTED", 64)
    draw = np.random.default_rng(6)
    sets = [np.unique(draw.zipf(1.3, 8).astype(np.uint64)) for _ in range(700)] + [np.array([1 << 40], np.uint64)] * 100
    whole, found = Counter(t for s in sets for t in s.tolist()), jaccard_join.FrequentShingles()
    for tokens in sets:
        found.add(tokens)
    found.settle()
    got = dict(zip(found.tokens.tolist(), found.counts.tolist()))
    slack = len(sets) // 20
    assert {t for t, c in whole.items() if c > slack} <= got.keys() and len(got) < len(whole) / 4
    assert all(whole[t] - slack <= c <= whole[t] for t, c in got.items())


def test_lossy_counts_hold_little():
    found = jaccard_join.FrequentShingles()
    draw = np.random.default_rng(7)
    tracemalloc.start()
    for _ in range(1 << 13):
        found.add(draw.integers(0, 1 << 63, 512).astype(np.uint64))
    found.settle()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64e6  # of 4 million shingles


def test_small_partitions_are_counted_together(spark):
    n = 8200
    docs = spark.range(n).select(F.concat(F.lit("a passage of five words "), "id").alias("text")).repartition(200)
    assert jaccard_join.shingle_counts(docs, 5, n).count() == 1


def test_shingles_are_dealt_once(spark, monkeypatch):
    plans = []

    def run(df):
        rows = df.collect()
        plans.append(df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0])
        return df.sparkSession.createDataFrame(rows, df.schema)

    monkeypatch.setattr(jaccard_join, "cut_lineage", run)
    profile = spark.createDataFrame([(1, [10, 11]), (2, [11, 12, 13]), (3, [13, 14]), (4, [15])], "set_id bigint, keys array<bigint>")
    assert sorted(map(tuple, jaccard_join._members(profile).collect())) == [(1, 1), (1, 2), (2, 2), (2, 3)]
    assert "ReusedExchange" in plans[0]


def test_similar_sets_share_a_key():
    draw = np.random.default_rng(8)
    order = draw.permutation(4000).astype(np.uint64)
    for percent in (80, 100, 67, 33):
        classes, met = jaccard_join.SizeClasses(percent), 0
        for _ in range(1500):
            m = int(draw.integers(1, 400))
            x = draw.choice(2000, m, replace=False)
            both = int(draw.integers(max(1, m * percent // 100), m + 1))
            y = np.concatenate([x[:both], 2000 + np.arange(draw.integers(0, max(1, 100 * both // percent - m + 1)))])
            if 100 * both >= percent * (m + len(y) - both):
                met += 1
                assert len(np.intersect1d(classes.keys(np.sort(order[x])), classes.keys(np.sort(order[y]))))
        assert met > 300


def test_sets_of_other_sizes_do_not_meet(spark):
    passage = " ".join(f"shared{i}" for i in range(40))
    docs = frame(spark, [(n, " ".join([passage, *(f"own{n}x{i}" for i in range(n - 40))])) for n in (100, 200, 400, 800)])
    common = spark.sparkContext.broadcast(np.empty(0, np.uint64))
    assert jaccard_join._members(jaccard_join.profiles(docs, 5, 80, common)).count() == 0


def test_keys_without_suggestions_are_dealt_once(spark, monkeypatch):
    dealt, deal = {}, jaccard_join._tree_pairs

    def run(members, classes, percent, forest):
        dealt[forest] = {r.set_id for r in members.select("set_id").collect()}
        return deal(members, classes, percent, forest)

    monkeypatch.setattr(jaccard_join, "_tree_pairs", run)
    passage = " ".join(f"shared{i}" for i in range(40))
    rows = [(n, " ".join([passage, *(f"own{n}x{i}" for i in range(100))])) for n in range(6)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(frame(spark, rows)).collect()}
    assert got == brute_components(rows)
    assert len(dealt[True]) == 6 and not dealt[False]


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 200 + i) for i in range(50)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "u bigint, v bigint")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100} | {200 + i: 100 for i in range(50)}


def test_trees_lose_no_pair():
    draw = np.random.default_rng(3)
    base = [draw.integers(0, 1 << 60, 100, dtype=np.uint64) for _ in range(5)]
    sets = [np.unique(np.concatenate([b[: draw.integers(70, 100)], draw.integers(0, 1 << 60, draw.integers(0, 20), dtype=np.uint64)])) for b in base for _ in range(20)]
    bits = folded([bitmap(s) for s in sets], 128)
    tree = SignatureTree(np.array([len(s) for s in sets]), bits, np.arange(len(sets)))
    found = {tuple(sorted(p)) for a, b in dual_join(tree, tree, 80) for p in zip(a.tolist(), b.tolist())}
    for i in range(len(sets)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            assert 100 * both < 80 * (len(sets[i]) + len(sets[j]) - both) or (j, i) in found


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="<p>no</p>";</script></head><body>
<nav><ul><li><a href="/x">menu one</a></li></ul></nav><div class="ad">Buy now</div><article><h1>Title &amp; more</h1><p><b>First
  par.<br><p>Second&nbsp;one.</p><div class="ad-box">advert inside</div><p>Third <a href="#">link</a> end</p>
<section class="comments"><article>a reader says</article></section></article><aside>side</aside><form>Mail <button>Go</button></form><footer>&copy; 1</footer></body>"""


def test_main_text(spark):
    bare = PAGE.replace("<article><h1>", "<div><h1>").replace("</section></article>", "</section></div>")
    rows = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (4, "u", "<p"), (5, "u", bare), (5, "u", bare), (6, "u", "<article>" + "<p>word</p>" * 5000), (7, "u", "plain words only")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("text", F.lit("clash"))
    got = {r.page_id: r for r in html_extract.extract_main_text(pages).collect()}
    want = "Title & more\nFirst par.\nSecond one.\nThird link end"
    assert got[1].text == want and got[1].n_chars == len(want)
    assert got[5].text.startswith("Title & more\nFirst par.\nSecond one.") and "menu" not in got[5].text and "reader" not in got[5].text
    assert [got[i].text for i in (2, 3, 4)] == ["", "", ""] and got[6].text.count("\n") == 4999
    assert html_extract.extract_main_text(pages.limit(0)).count() == 0


STORY = "<p>The story has words</p><p>and more words of its own</p>"


@pytest.mark.parametrize(
    "before, around, after",
    [
        ("<nav><ul>" + "<li>menu entry" * 100 + "</ul></nav>", "article", ""),
        ("<form><select>" + "<option>choice" * 100 + "</select></form>", "article", ""),
        ("<nav><dl>" + "<dt>name<dd>value" * 100 + "</dl></nav>", "article", ""),
        ("<nav><table>" + "<tr><td>cell<td>cell" * 100 + "</table></nav>", "article", ""),
        ("<nav>" + "<b>" * 100 + "</nav>", "article", ""),
        ('<div class="content-sidebar-wrap">', "main", '<div class="sidebar">side words</div></div>'),
        ('<div class="content-sidebar-wrap">', "article", '<div class="sidebar">side words</div></div>'),
        ("<form>", "article", "<button>choice</button></form>"),
        ("<head><title>menu</title><body>", "article", ""),
        ("", "article", '<div class="related"><article>side words of another story</article></div>'),
        ("", "article", "<aside><article>side words of another story</article></aside>"),
        ("", "main", '<div class="comments"><article>side words of a reader</article></div>'),
    ],
)
def test_article_is_kept_whole(before, around, after):
    page = f"{before}<{around}>{STORY}</{around}>{after}"
    assert html_extract.main_text(page, html_extract.Weights({})) == "The story has words\nand more words of its own"


def test_paragraph_ends_below_many_inline_elements():
    places = [place for place, text, _ in html_extract.tokens("<p>" + "<b>" * 20 + "one<ul><li>two</ul>three") if place and text.strip()]
    assert places == [("body", "p", False), ("body", "li", False), ("body", "body", False)]


def test_best_region():
    assert html_extract.best_region([-1, 2, -1, 3, -5, 4]) == (1, 4)
    assert html_extract.best_region([-1, -2]) == (0, 0) and html_extract.best_region([]) == (0, 0)
