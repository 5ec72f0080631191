"""Each operator against a plain version, on odd rows and on the smallest tables."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablesift.llm import bpe, catalog, common, components, decontaminate, fm_index, jaccard_join, line_dedup, lm_score, packing, suffix_dedup, token_counts, topk, toxicity, two_stage, url_filter
from tests.compare import duck, duck_rows, spark_rows
from tests.llm.conftest import DOCUMENTS, odd_rows, words

ORACLES = catalog.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, sf_dir, name):
    columns, rows = spark_rows(catalog.queries()[name](spark, sf_dir))
    assert (columns, rows) == duck_rows(duck(sf_dir), ORACLES[name])


def texts(spark, sf_dir):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]


# --- 1: decontamination ------------------------------------------------------------------------------------------


def plain_hits(text, items, window=10):
    doc = decontaminate.words(text)
    hit, found = set(), set()
    for item, body in items:
        own = decontaminate.words(body)
        for a in range(max(1, len(own) - window + 1)) if own else ():
            w = own[a : a + window]
            for p in range(len(doc) - len(w) + 1):
                if doc[p : p + len(w)] == w:
                    hit.update(range(p, p + len(w)))
                    found.add(str(item))
    return len(doc), len(hit), sorted(found)


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, " ".join(words(1, 120).split()[40:60])), (2, "word"), (3, None), (None, "alpha1 beta2"), (4, ""), (5, words(4, 60)), (5, "x y"), (12, "a" * 5000), (13, "idiot")]
    return rows, spark.createDataFrame(rows, "item_id long, text string")


def test_contamination_of_odd_rows(odd, items):
    rows, benchmark = items
    found = decontaminate.find_contamination(odd, "doc_id", "text", benchmark, "item_id", "text")
    got = sorted((str(r["doc_id"]), r.n_words, r.n_hit, list(r["items"])) for r in found.collect())
    usable = [(i, t) for i, t in rows if i is not None and t]
    assert got == sorted((str(d[0]), *plain_hits(d[1], usable)) for d in odd_rows())


def test_blocks_of_the_benchmark_give_the_same(odd, items, monkeypatch):
    _, benchmark = items
    one = decontaminate.find_contamination(odd, "doc_id", "text", benchmark, "item_id", "text")
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 300)
    many = decontaminate.find_contamination(odd, "doc_id", "text", benchmark, "item_id", "text")
    assert spark_rows(one) == spark_rows(many)


def test_removal_cuts_just_the_passages(odd, items, empty):
    _, benchmark = items
    cut = decontaminate.remove_contamination(odd, "text", benchmark, "item_id", "text")
    assert cut.columns == odd.columns
    assert decontaminate.find_contamination(cut, "doc_id", "text", benchmark, "item_id", "text").filter("n_hit > 0").count() == 0
    texts = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert 8 not in texts and texts[6] == "" and texts[5] is None
    assert texts[1] == " ".join(words(1, 120).split()[:40]) + "  " + " ".join(words(1, 120).split()[60:])
    none = benchmark.limit(0)
    assert spark_rows(decontaminate.remove_contamination(odd, "text", none, "item_id", "text")) == spark_rows(odd)
    assert decontaminate.remove_contamination(empty, "text", benchmark, "item_id", "text").count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(1, 4), max_size=30), min_size=1, max_size=5), st.lists(st.integers(1, 4), min_size=1, max_size=5))
def test_fm_index_finds_all(runs, phrase):
    text = np.array([x for r in runs for x in [*r, 0]], dtype=np.int64)
    index = fm_index.FMIndex(text, 4, every=4)
    low, high = index.search(np.array([phrase]), np.array([len(phrase)]))
    found = sorted(index.locate(np.arange(low[0], high[0])).tolist())
    assert found == [p for p in range(len(text) - len(phrase) + 1) if text[p : p + len(phrase)].tolist() == phrase]


# --- 2, 5: tokens ------------------------------------------------------------------------------------------------


def library(tokenizer):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer)


def test_counts_of_odd_rows(odd, empty, tokenizer):
    lib = library(tokenizer)
    got = sorted((str(r["doc_id"]), r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.count_tokens(odd, "doc_id", "text", tokenizer).collect())
    n = [len(lib.encode(d[1] or "", add_special_tokens=False).ids) for d in odd_rows()]
    assert got == sorted((str(d[0]), len((d[1] or "").encode()), k, k > 1024) for d, k in zip(odd_rows(), n, strict=True))
    assert token_counts.count_tokens(empty, "doc_id", "text", tokenizer).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab's \n\té\u0300\u2028日9²!<|endoftext|>\x1c\x85🙂")), max_size=30))
def test_ids_are_the_library_s(text):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    own = bpe.loaded(path)
    ids = library(path).encode(text, add_special_tokens=False).ids
    assert own.ids(text) == ids
    assert sum(own.lengths(own.pieces(text))) == len(ids)


def test_other_files_are_left_to_their_library(tmp_path, tokenizer):
    """A file whose merges are not in id order is not proven, and pieces are whole texts."""
    import json

    content = json.loads(open(tokenizer, encoding="utf-8").read())
    vocabulary = content["model"]["vocab"]
    a, b = [t for t, i in vocabulary.items() if i in (300, 301)]
    vocabulary[a], vocabulary[b] = vocabulary[b], vocabulary[a]
    (tmp_path / "other.json").write_text(json.dumps(content))
    own, text = bpe.BpeTokenizer(str(tmp_path / "other.json")), "The cat's <|endoftext|> 123 " + words(5, 40)
    expected = library(str(tmp_path / "other.json")).encode(text, add_special_tokens=False).ids
    assert own._fast is None and own.ids(text) == expected and sum(own.lengths(own.pieces(text))) == len(expected)


def test_misra_gries_keeps_the_heavy():
    kept = token_counts._pruned(Counter({"a": 100, "b": 50, **{str(i): 1 for i in range(100)}}), 10)
    assert len(kept) <= 10 and kept["a"] == 99 and kept["b"] == 49


def check_packing(pieces, docs, length=2048):
    by_row, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_row[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append((p["offset"], p["length"]))
    for sequence, parts in by_sequence.items():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at and n > 0
            at += n
        assert at == length or sequence == max(by_sequence)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for key, rows in docs.items():
        own = sorted((p["start"], p["length"], p["ids_crc32"], p["doc_tokens"]) for p in by_row[key])
        expected = Counter()
        for ids in rows:
            expected[len(ids)] += len(ids)
        assert sum(n for _, n, _, _ in own) == sum(map(len, rows))
        if len(rows) == 1:
            at = 0
            for start, n, crc, total in own:
                assert start == at and total == len(rows[0])
                assert crc == zlib.crc32(np.array(rows[0][start : start + n], dtype="<u4").tobytes())
                at += n


def test_packing_is_a_round_trip(spark, sf_dir, odd, empty, tokenizer):
    lib = library(tokenizer)
    for df, rows in ((odd, [(d[0], d[1]) for d in odd_rows()]), (spark.read.parquet(f"{sf_dir}/documents.parquet"), texts(spark, sf_dir))):
        docs = defaultdict(list)
        for key, text in rows:
            docs[key].append(lib.encode(text or "", add_special_tokens=False).ids + [1])
        check_packing(packing.pack(df, "doc_id", "text", "source", tokenizer).collect(), docs)
    assert packing.pack(empty, "doc_id", "text", "source", tokenizer).count() == 0


@pytest.mark.parametrize("mixture", [None, {"a": 3.0, "b": 1.0}])
def test_round_robin_is_that_of_a_scheduler(spark, mixture, monkeypatch):
    monkeypatch.setattr(packing, "_BLOCK", 2)
    rows = [(p, i, q, n) for p in range(3) for i, (q, n) in enumerate([("=a", 7), ("=b", 3), ("=a", 1), ("=c", 9), ("=b", 12), ("=a", 30)])]
    lengths = spark.createDataFrame(rows, "part int, idx long, queue string, n_tokens long")
    got = [(r.part, r.idx, r.window) for r in packing.round_robin(lengths, 20, mixture).orderBy("at").collect()]
    total = Counter()
    for _, _, q, n in rows:
        total[q] += n
    whole = sum(total.values())
    quantum = {q: 20 * n / whole if mixture is None else 20 * mixture.get(q[1:], 0) / 4 for q, n in total.items()}
    windows = max(math.ceil(n / quantum[q]) for q, n in total.items() if quantum[q])
    quantum = {q: quantum[q] or n / windows for q, n in total.items()}
    queues = {q: [r for r in rows if r[2] == q] for q in sorted(total)}
    deficit, order, window = dict.fromkeys(queues, 0.0), [], 0
    while any(queues.values()):
        for q, rest in queues.items():
            if rest:
                deficit[q] += quantum[q]
                while rest and rest[0][3] <= deficit[q] + 1e-9:
                    deficit[q] -= rest[0][3]
                    order.append((rest[0][0], rest[0][1], window))
                    rest.pop(0)
        window += 1
    assert got == order


# --- 3: near copies ----------------------------------------------------------------------------------------------


def plain_components(rows):
    sets = []
    for _, text in rows:
        w = (text or "").encode().translate(jaccard_join.LOWER).split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    smallest = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            smallest[root(i)] = min(key, smallest.get(root(i), key))
    return [(str(key), len(s), str(smallest.get(root(i)))) for i, ((key, _), s) in enumerate(zip(rows, sets, strict=True))]


def test_components_of_odd_rows(odd, empty):
    got = sorted((str(r["doc_id"]), r.n_shingles, str(r.component_id)) for r in jaccard_join.linked(odd, "doc_id", "text").collect())
    assert got == sorted(plain_components([(d[0], d[1]) for d in odd_rows()]))
    assert jaccard_join.linked(empty, "doc_id", "text").count() == 0


def test_components_of_many_edits(spark, monkeypatch):
    """Families at and around the threshold, hot shingles, hot keys dealt over several tasks."""
    monkeypatch.setattr(common, "KEY_ROWS", 3)
    monkeypatch.setattr(jaccard_join, "HOT", (1, 2))
    rows = []
    for family in range(4):
        base = words(100 + family, 70).split() + words(99, 30).split()
        for k in range(40):
            own = list(base)
            for e in range(k % 6):
                own[(k * 7 + e * 13) % len(own)] = f"edit{family}x{k}x{e}"
            rows.append((family * 1000 + k, " ".join(own)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted((str(r["doc_id"]), r.n_shingles, str(r.component_id)) for r in jaccard_join.linked(df, "doc_id", "text").collect())
    expected = sorted(plain_components(rows))
    assert got == expected
    assert 4 < len({e[2] for e in expected}) < len(rows)


@pytest.mark.parametrize("small", [0, 10**6])
def test_components_of_paths_stars_and_cycles(spark, monkeypatch, small):
    monkeypatch.setattr(components, "SMALL", small)
    monkeypatch.setattr(common, "KEY_ROWS", 2)
    edges = [(i, i + 1) for i in range(100, 140)] + [(0, i) for i in range(1, 60)] + [(200, 201), (201, 202), (202, 200), (300, 300), (59, 400)]
    found = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 100 for i in range(100, 141)}, **{i: 0 for i in range(60)}, 400: 0, 200: 200, 201: 200, 202: 200}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_of_each_keeps_clean_rows(odd):
    kept = jaccard_join.one_of_each(odd, "doc_id", "text")
    assert kept.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(["1", "4", "5", "6", "7", "8", "None", "None", "9", "9", "10", "11", "12", "13", "14", "15"])


# --- 4: urls -----------------------------------------------------------------------------------------------------


def test_urls(spark):
    rows = [(1, "http://a.net/x"), (2, "HTTPS://Sub.Example.NET/en/1?q"), (3, "http://example.com/de/"), (4, "http://example.com/d"), (5, "x.net/"), (6, None), (7, "http://fr.org/fr/#a"), (8, "http://notexample.com/de/x"), (9, "http://net"), (10, "a://b://c.net/"), (11, ""), (1, "http://a.net/x")]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit("x"))
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.filter_urls(df, "page_id", "url").collect()}
    assert got[1] == ("a.net", "/x", "net/", "block")
    assert got[2] == ("sub.example.net", "/en/1", "example.net/en/", "allow")
    assert got[3] == ("example.com", "/de/", "example.com/de/", "block")
    assert got[4] == ("example.com", "/d", None, "allow")
    assert got[5] == got[6] == got[11] == ("", "", None, "allow")
    assert got[7] == ("fr.org", "/fr/", "org/fr/", "allow")
    assert got[8] == ("notexample.com", "/de/x", None, "allow")
    assert got[9] == ("net", "", None, "allow")
    assert got[10] == ("b:", "//c.net/", None, "allow")
    assert url_filter.filter_urls(df, "page_id", "url").count() == len(rows)
    assert url_filter.filter_urls(df, "page_id", "url", rules=()).filter("rule is not null").count() == 0


def test_long_hosts_probe_no_more_than_the_rules_need(tmp_path, spark):
    names = {}
    for kind, content in url_filter.build_index(url_filter.RULES).items():
        (tmp_path / kind).write_bytes(content)
        names[kind] = str(tmp_path / kind)
    index = url_filter.DigestIndex(names)
    dots = "a." * 200_000
    assert index.match([dots + "example.com", dots + "net", dots, "xexample.com", ".net", "net."], ["/de/" + "x" * 300_000, "/", "/", "/de/", "/", "/"]) == [("example.com/de/", True), ("net/", True), None, None, ("net/", True), None]
    rows = [("k", "http://" + dots + "example.net/en/" + "y" * 300_000), (None, "http://" + dots + "example.com/de"), ("k", None)]
    got = url_filter.filter_urls(spark.createDataFrame(rows, "page_id string, url string"), "page_id", "url").collect()
    assert [(r.page_id, len(r.host), len(r.path), r.rule, r.verdict) for r in got] == [("k", 400_011, 300_004, "example.net/en/", "allow"), (None, 400_011, 3, None, "allow"), ("k", 0, 0, None, "allow")]
    assert url_filter.filter_urls(spark.createDataFrame([], "page_id long, url string"), "page_id", "url").count() == 0


def test_ids_of_other_types(spark):
    rows = [(k, t) for k, t in (("a", words(1, 120)), ("b", words(1, 120)), ("c", words(2, 50)))]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    assert {r.doc_id: r.component_id for r in jaccard_join.linked(df, "doc_id", "text").collect()} == {"a": "a", "b": "a", "c": "c"}
    assert {r.doc_id: r.text for r in line_dedup.remove_runs(df, "doc_id", "text").collect()} == {"a": rows[0][1], "b": "", "c": rows[2][1]}
    for call in (lambda: suffix_dedup.remove_repeats(df, "doc_id", "text"), lambda: topk.top_k(df.withColumn("v", F.array(F.lit(1.0))), "doc_id", "v")):
        with pytest.raises(TypeError, match="integer id"):
            call()


def test_equal_digests_are_told_apart_by_their_strings(tmp_path, monkeypatch):
    monkeypatch.setattr(url_filter.xxhash, "xxh64_intdigest", lambda s: 7)
    names = {}
    for kind, content in url_filter.build_index((("a", "/", "block"), ("b", "/", "allow"))).items():
        (tmp_path / kind).write_bytes(content)
        names[kind] = str(tmp_path / kind)
    index = url_filter.DigestIndex(names)
    assert index.match(["a", "b", "c", "x.a"], ["/", "/", "/", "/"]) == [("a/", True), ("b/", False), None, ("a/", True)]


# --- 6: lines ----------------------------------------------------------------------------------------------------


def plain_lines(rows, least):
    """Kept text of each distinct (id, text); equal runs of lines of at least `least` characters, later ones deleted."""
    docs = sorted({(k, t) for k, t in rows if k is not None and t is not None}, key=lambda d: d[0])
    seen, gone = {}, defaultdict(set)
    places = []
    for k, t in docs:
        lines = [(i, x) for i, x in enumerate(t.split("\n")) if x.strip(" ")]
        for a in range(len(lines)):
            for e in range(a, min(len(lines), a + 400)):
                body = tuple(x for _, x in lines[a : e + 1])
                if sum(map(len, body)) >= least:
                    places.append(((k, lines[a][0]), lines[e][0], body, (k, t)))
    for place, last, body, key in sorted(places, key=lambda p: p[0]):
        if body in seen:
            gone[key].update(range(place[1], last + 1))
        else:
            seen[body] = place
    return {key: "\n".join(x for i, x in enumerate(key[1].split("\n")) if i not in gone[key]) for key in docs}


def test_line_runs(spark, empty):
    a, b, c = ("\n".join(words(s + i, 9) for i in range(5)) for s in (200, 300, 400))
    short = "of.\nyes."
    rows = [(1, a), (2, a + "\n" + b), (3, short), (4, short), (5, words(1, 8) + "\n" + c + "\n\n" + b), (6, c.replace("\n", "\n\n")), (7, None), (8, ""), (8, "x"), (9, a), (9, a), (10, "\n".join(["q" * 30] * 30)), (None, a), (11, words(2, 5000))]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"line": F.lit(1), "ranges": F.lit("r"), "version": F.lit(None).cast("int")}).repartition(3)
    kept = line_dedup.remove_runs(df, "doc_id", "text")
    expected = plain_lines(rows, line_dedup.LEAST)
    got = [((r["doc_id"]), r["text"], r["line"]) for r in kept.collect()]
    assert len(got) == len(rows) and all(g[2] == 1 for g in got)
    assert sorted((str(k), str(t)) for k, t, _ in got) == sorted((str(k), str(expected.get((k, t), t))) for k, t in rows)
    assert line_dedup.remove_runs(empty, "doc_id", "text").count() == 0


def test_line_runs_of_odd_rows(odd):
    expected = plain_lines([(d[0], d[1]) for d in odd_rows() if d[0] not in (10,)], line_dedup.LEAST)
    kept = {(r["doc_id"], r["text"]) for r in line_dedup.remove_runs(odd, "doc_id", "text").collect()}
    assert {(k[0], v) for k, v in expected.items() if k[0] not in (9,)} <= kept


def shuffled(spark):
    context = spark.sparkContext._jsc.sc()
    context.listenerBus().waitUntilEmpty()
    found = context.statusStore().executorList(True)
    return sum(found.apply(i).totalShuffleWrite() for i in range(found.size()))


def test_texts_that_keep_their_lines_stay_where_they_are(spark, monkeypatch):
    """However large the tables are, so without the broadcast of small ones."""
    rng = np.random.default_rng(6)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789-_"))
    rows = [(k, "".join(letters[rng.integers(0, 64, 40_000)])) for k in range(100)]
    rows += [(100 + k, rows[0][1] + f"\n{k}") for k in range(3)] + [(None, rows[0][1]), (200, None)]
    expected = plain_lines(rows, line_dedup.LEAST)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(key, -1)
    try:
        for full in (False, True):
            if full:  # a filter that rules nothing out
                monkeypatch.setattr(line_dedup, "_slots", lambda version, blocks: tuple(F.lit(x).cast("long") for x in (0, 0, 1)))
            kept = line_dedup.remove_runs(df.persist(), "doc_id", "text")
            began = shuffled(spark)
            got = [(r.doc_id, r.text) for r in kept.collect()]
            moved = shuffled(spark) - began
            assert sorted(map(str, got)) == sorted(str((k, expected.get((k, t), t))) for k, t in rows)
            assert (moved > 2_000_000) if full else (moved < 500_000)
    finally:
        df.unpersist()
        for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.unset(key)


# --- 7: language model -------------------------------------------------------------------------------------------


def test_scores_of_odd_rows(odd, empty):
    rows = [(d[0], d[1]) for d in odd_rows()]
    found = lm_score.score_texts(odd, "doc_id", "text").collect()
    assert len(found) == len(rows)

    def held(key):
        return zlib.crc32(("" if key is None else str(key)).encode()) % 5 == 1

    counts = Counter()
    for key, text in rows:
        if not held(key):
            counts.update([*lm_score.split(text), b""])
    total, distinct = sum(counts.values()), len(counts)
    below = math.log10(total + 0.5 * (distinct + 1))
    expected = sorted((str(k), held(k), len(lm_score.split(t)) + 1, sum(counts[w] > 0 for w in [*lm_score.split(t), b""]), total, round(sum(math.log10(counts[w] + 0.5) - below for w in [*lm_score.split(t), b""]), 4)) for k, t in rows)
    assert sorted((str(r["doc_id"]), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in found) == expected
    assert all(r.score < 0 and math.isfinite(r.score) for r in found)
    assert lm_score.score_texts(empty, "doc_id", "text").count() == 0


def test_the_model_is_a_distribution():
    """The probabilities of all symbols after any two add up to one, and a word's spelling is a proper code."""
    rng = np.random.default_rng(1)
    words_ = [f"w{i}".encode() for i in range(30)]
    coder = lm_score.build_coder(words_, list(range(60, 30, -1)), 10, 5)
    one, two = (rng.integers(-800, 800, 1 << b).astype(np.int16) << 3 | rng.integers(0, 8, 1 << b).astype(np.int16) for b in coder.slots)
    tables = [rng.integers(0, 9, n) for n in coder.table_sizes()[2:]]
    mixer = lm_score.Mixer()
    model = lm_score.Model(coder, one, two, lm_score.Speller(tables), mixer, mixer.rates(), np.ones((16, 2)))
    symbols = np.arange(32)
    d = lm_score.Decisions(coder, symbols, np.full(32, 3), np.full(32, 4))
    bits = mixer.bits(d.odds, model.one[d.one], model.two[d.two], d.bits, model.rates)
    assert np.isclose((2.0 ** -np.add.reduceat(bits.astype(float), d.offset)).sum(), 1, atol=1e-3)
    each = np.array([model.speller.bits([bytes([c])])[0] - model.speller.bits([bytes([c]) + b" "])[0] for c in range(1, 3)])
    assert (each < 0).all()


def test_the_model_beats_unigrams_on_repeated_context(spark):
    text = " ".join(f"one{i % 7} two{i % 7} three{i % 7}" for i in range(300))
    df = spark.createDataFrame([(i, text) for i in range(60)], "doc_id long, text string")
    held = [r for r in lm_score.score_texts(df, "doc_id", "text").collect() if r.held_out]
    assert held and all(r.score > 0.3 * r.base_score for r in held)


class PlainMixer:
    """The model bit by bit: dictionaries for tables, one decision after the other; corrections at the ends of blocks."""

    def __init__(self, coder):
        self.coder, self.counts, self.letters = coder, defaultdict(lambda: [0, 0]), Counter()
        self.w = [[0.4, 0.4, 0.3, 0.0] for _ in range(64)]
        self.squares = [[1e-4] * 4 for _ in range(64)]
        self.refined = [[0, 0] for _ in range(8 * 32)]

    def decisions(self, symbol, before, before_two):
        """(bit, odds of the node, slot of one word, slot of two words)"""
        d = lm_score.Decisions(self.coder, np.array([symbol]), np.array([before]), np.array([before_two]))
        return list(zip(d.bits.tolist(), d.odds.tolist(), d.one.tolist(), d.two.tolist(), strict=True))

    def inputs(self, one, two, rounded):
        odds, seen = [], []
        for key in (("one", one), ("two", two)):
            zeros, ones = self.counts[key]
            x = math.log((ones + 0.4) / (zeros + 0.4))
            odds.append(max(-4095, min(4095, round(x * 256))) / 256 if rounded else x)
            seen.append(min(7, (zeros + ones).bit_length()))
        return odds, seen[1] * 8 + seen[0], seen[1]

    def mixed(self, own, odds, gate):
        w = self.w[gate]
        return max(-11.0, min(11.0, w[3] + w[0] * own + w[1] * odds[0] + w[2] * odds[1]))

    def bucket(self, x, level):
        return level * 32 + int((x + 11) * (32 - 0.01) / 22)

    def learn(self, block):
        steps = []
        for symbol in block:
            for bit, own, one, two in self.decisions(*symbol):
                odds, gate, level = self.inputs(one, two, False)
                x = self.mixed(own, odds, gate)
                steps.append((gate, (own, *odds, 1.0), bit - 1 / (1 + math.exp(-x)), self.bucket(x, level), bit, one, two))
        for gate in {s[0] for s in steps}:
            mine = [s for s in steps if s[0] == gate]
            for i in range(4):
                g = sum(s[1][i] * s[2] for s in mine) / len(mine)
                self.squares[gate][i] += g * g
                self.w[gate][i] += lm_score.RATE * g / math.sqrt(self.squares[gate][i])
        for _, _, _, bucket, bit, one, two in steps:
            self.refined[bucket][bit] += 1
            self.counts["one", one][bit] += 1
            self.counts["two", two][bit] += 1

    def cost(self, symbol):
        total = 0.0
        for bit, own, one, two in self.decisions(*symbol):
            odds, gate, level = self.inputs(one, two, True)
            x = self.mixed(own, odds, gate)
            bucket = self.bucket(x, level)
            zeros, ones = self.refined[bucket]
            middle = (bucket % 32 + 0.5) * 22 / 32 - 11
            rate = (ones + 8 / (1 + math.exp(-middle))) / (zeros + ones + 8)
            p = (1 / (1 + math.exp(-x)) + rate) / 2
            total -= math.log2(max(1e-6, p if bit else 1 - p))
        return total

    def spell(self, word):
        for order in (1, 2, 3):
            for context, c in self.spelled(word, order):
                self.letters[order, context] += 1
                self.letters[order, context, c] += 1

    def spelled(self, word, order):
        text = b"   " + word + b" "
        return [(text[i - order : i], text[i]) for i in range(3, len(text))]

    def letters_cost(self, word):
        total = 0.0
        for steps in zip(*(self.spelled(word, k) for k in (1, 2, 3)), strict=True):
            p = 1 / 256
            for order, (context, c) in enumerate(steps, 1):
                p = (self.letters[order, context, c] + 4 * p) / (self.letters[order, context] + 4)
            total -= math.log2(p)
        return total


def test_scores_equal_a_plain_mixer(spark):
    rows = [(i, " ".join(f"w{(i * k * 7 + k) % 19}" + ("" if k % 5 else f"x{i}y{k % 15}") for k in range(40 + i))) for i in range(24)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r.score for r in lm_score.score_texts(df, "doc_id", "text").collect()}
    training = [lm_score.split(t) for i, t in rows if zlib.crc32(str(i).encode()) % 5 != 1]
    counts = Counter(w for d in training for w in d)
    coded = sorted((w for w, n in counts.items() if n >= lm_score.LEAST), key=lambda w: (-counts[w], w))
    tokens = sum(counts.values()) + len(training)
    escapes = sum(n for w, n in counts.items() if n < lm_score.LEAST)
    coder = lm_score.build_coder(coded, [counts[w] for w in coded], len(training), escapes, lm_score.slot_bits(tokens))
    name = {w: i + 2 for i, w in enumerate(coded)}

    def symbols(doc):
        own = [0, 0, *(name.get(w, 1) for w in doc), 0]
        return [(own[i], own[i - 1], own[i - 2]) for i in range(2, len(own))]

    model, a, block = PlainMixer(coder), 0, lm_score.FIRST_BLOCK
    stream = [x for d in training for x in symbols(d)]
    while a < len(stream):
        model.learn(stream[a : a + block])
        a, block = a + block, min(2 * block, lm_score.BLOCK)
    for w in counts:
        model.spell(w)

    def escapes(doc):
        seen = []
        for w in doc:
            if w not in name:
                yield w, w in seen, len(seen)
                if w not in seen:
                    seen.append(w)

    again = defaultdict(lambda: [0, 0])
    for d in training:
        for _, known, had in escapes(d):
            again[min(15, math.ceil(math.log2(had + 1)))][known] += 1
    for i, t in rows:
        doc = lm_score.split(t)
        bits = sum(map(model.cost, symbols(doc)))
        for w, known, had in escapes(doc):
            new, old = again[min(15, math.ceil(math.log2(had + 1)))]
            p = (old + 0.5) / (new + old + 1)
            bits += 0.0 if not had else -math.log2(p if known else 1 - p)
            bits += math.log2(had) if known else model.letters_cost(w)
        assert math.isclose(got[i], -bits * math.log10(2), rel_tol=2e-3), i


def test_tables_grow_with_the_corpus():
    assert [lm_score.slot_bits(n)[0] for n in (0, 1 << 18, 1 << 20, 1 << 22, 1 << 30)] == [18, 18, 19, 21, 21]


def test_every_decision_corrects_the_mixer(spark):
    text = words(1, 60_000)
    counts = Counter(lm_score.split(text))
    coder = lm_score.build_coder(list(counts), list(counts.values()), 1, 1)
    rows = lm_score._trained(spark.createDataFrame([(text,)], "text string").coalesce(1), spark.sparkContext.broadcast(coder), "every").collect()
    weighed = next(np.frombuffer(r["content"]) for r in rows if r["kind"] == lm_score._WEIGHTS)
    counted = sum(int(np.frombuffer(r["content"], dtype={2: "<u2", 8: "<i8"}[r["width"]]).sum()) for r in rows if r["kind"] == 0)
    assert weighed[-1] == counted > lm_score.BLOCK
    refined = next(np.frombuffer(r["content"]) for r in rows if r["kind"] == lm_score._REFINED)
    assert refined.sum() == counted


def test_a_task_of_one_block_learns_the_contexts(spark):
    text = words(1, 20_000)
    counts = Counter(lm_score.split(text))
    coder = lm_score.build_coder(list(counts), list(counts.values()), 1, 1)
    rows = lm_score._trained(spark.createDataFrame([(text,)], "text string").coalesce(1), spark.sparkContext.broadcast(coder), "small").collect()
    weighed = next(np.frombuffer(r["content"]) for r in rows if r["kind"] == lm_score._WEIGHTS)
    learned = (weighed[:-1] / weighed[-1]).reshape(-1, 4) - lm_score.Mixer().weights
    assert (np.abs(learned[:, 1:3]) > 1e-3).any()


# --- 8: top k ----------------------------------------------------------------------------------------------------


def test_top_k_with_odd_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 6) / 4]) for i in range(400)]
    rows += [(50, [float("nan")] * 6), (500, None), (550, [1.0, None] + [0.0] * 4), (600, [1.0, 2.0]), (650, []), (None, [1.0] * 6), (700, [float("inf")] + [0.0] * 5), (7, rows[7][1]), (750, [1e30] * 6), (751, [-1e30] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"id": F.lit("x"), "score": F.lit(1), "rank": F.lit(2)}).repartition(3)
    got = defaultdict(list)
    for r in topk.top_k(df, "vec_id", "embedding").orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    sound = [(k, [math.floor(256 * float(np.float32(x))) for x in v]) for k, v in rows if k is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    for query, q in sound:
        if query % 50 == 0:
            scores = [(max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(q, v, strict=True)))), k) for k, v in sound if k != query and len(v) == len(q)]
            best = sorted(scores, key=lambda s: (-s[0], s[1]))[:5]
            assert got[query] == [(i + 1, k, s) for i, (s, k) in enumerate(best)], query
    assert topk.top_k(df.limit(0), "vec_id", "embedding").count() == 0


def test_query_blocks_and_shards_give_the_same(spark, sf_dir, monkeypatch):
    whole = spark_rows(topk.op8_topk(spark, sf_dir))
    monkeypatch.setattr(topk, "QUERY_BLOCK", 2)
    monkeypatch.setattr(topk, "SHARD", 900)
    assert spark_rows(topk.op8_topk(spark, sf_dir)) == whole


def test_large_components_are_exact():
    """256 components near 2^25: sums pass 2^53, where doubles round."""
    rng = np.random.default_rng(11)
    for trial in range(12):
        vectors = (1 << 25) - 1 - rng.integers(0, 3, (60, 256))
        queries = (1 << 25) - 1 - rng.integers(0, 3, (4, 256))
        for q, found, scores in topk.SortedLists(np.arange(60), vectors).best(np.full(4, -1), queries, 5):
            best = sorted((-sum(int(a) * int(b) for a, b in zip(v, queries[q], strict=True)), i) for i, v in enumerate(vectors))[:5]
            assert [(-s, i) for s, i in zip(scores.tolist(), found.tolist(), strict=True)] == best, trial


def test_bars_leave_out_only_what_is_below():
    rng = np.random.default_rng(12)
    vectors, queries = rng.integers(-50, 51, (300, 16)), rng.integers(-50, 51, (5, 16))
    scores = vectors @ queries.T
    bars = np.sort(scores, axis=0)[-3].astype(float)
    for q, found, got in topk.SortedLists(np.arange(300), vectors).best(np.full(5, -1), queries, 5, bars):
        best = sorted((-int(s), i) for i, s in enumerate(scores[:, q]))[:3]
        assert [(-s, i) for s, i in zip(got.tolist(), found.tolist(), strict=True)][:3] == best


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 60), st.integers(1, 5))
def test_nra_is_exact(seed, n, dims):
    rng = np.random.default_rng(seed)
    vectors = rng.integers(-4, 5, (n, dims))
    ids = rng.permutation(n) * 3
    queries = rng.integers(-4, 5, (3, dims))
    own = np.array([ids[0], -1, -2])
    for q, found, scores in topk.SortedLists(ids, vectors).best(own, queries, 4):
        best = sorted(((-int(v @ queries[q]), int(i)) for i, v in zip(ids, vectors, strict=True) if i != own[q]))[:4]
        assert [(-s, i) for s, i in zip(scores.tolist(), found.tolist(), strict=True)] == best


def test_only_survivors_of_the_bounds_are_scored(monkeypatch):
    rng = np.random.default_rng(5)
    vectors, queries = rng.integers(-200, 201, (400, 64)), rng.integers(-200, 201, (6, 64))
    ids, scored, ranked = np.arange(400), [], topk.SortedLists._ranked
    monkeypatch.setattr(topk.SortedLists, "_ranked", lambda self, rows, *rest: scored.append(len(rows)) or ranked(self, rows, *rest))
    for q, found, scores in topk.SortedLists(ids, vectors).best(np.full(6, -1), queries, 5):
        best = sorted((-int(v @ queries[q]), i) for i, v in enumerate(vectors))[:5]
        assert [(-s, i) for s, i in zip(scores.tolist(), found.tolist(), strict=True)] == best
    assert len(scored) == 6 and max(scored) <= 8


# --- 9: repeated bytes -------------------------------------------------------------------------------------------


def plain_repeats(rows):
    first = {}
    for key, text in sorted((r for r in rows if r[0] is not None and r[1]), key=lambda r: r[0]):
        raw = text.encode()
        for p in range(len(raw) - 49):
            first.setdefault(raw[p : p + 50], key)
    out = []
    for key, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        if key is not None:
            for p in range(len(raw) - 49):
                if first[raw[p : p + 50]] < key:
                    gone[p : p + 50] = b"\1" * 50
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = sum(1 for p in range(len(gone)) if gone[p] and (p == 0 or not gone[p - 1]))
        out.append((str(key), len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def test_repeats_of_odd_rows(odd, empty):
    got = sorted((str(r["doc_id"]), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(odd, "doc_id", "text").collect())
    assert got == plain_repeats([(d[0], d[1]) for d in odd_rows()])
    assert suffix_dedup.remove_repeats(empty, "doc_id", "text").count() == 0


def test_kept_bytes_are_returned(spark):
    passage = words(50, 30)
    df = spark.createDataFrame([(1, "x " + passage), (2, "head " + passage + " tail")], "doc_id long, text string")
    kept = {r.doc_id: bytes(r.kept) for r in suffix_dedup.remove_repeats(df, "doc_id", "text", with_kept=True).collect()}
    assert kept == {1: ("x " + passage).encode(), 2: b"head tail"}


@settings(max_examples=80, deadline=None)
@given(st.lists(st.binary(max_size=70).map(lambda b: bytes(x % 3 for x in b)) | st.text(alphabet="ab", max_size=80).map(str.encode), max_size=6))
def test_two_stage_sort(strings):
    sorter = two_stage.Strings(strings)
    order = sorter.suffix_array(56)
    suffixes = [strings[sorter.owner[p]][p - sorter.starts[sorter.owner[p]] :] for p in order]
    assert len(order) == sum(map(len, strings)) == len(set(order.tolist()))
    assert [s[:56] for s in suffixes] == sorted(s[:56] for s in suffixes)
    common = sorter.common_prefixes(order)
    for a, b, n in zip(suffixes, suffixes[1:], common[1:], strict=False):
        assert a[:n] == b[:n] and (n in (len(a), len(b)) or a[n] != b[n])


def test_chunk_and_shard_sizes_do_not_matter(spark, sf_dir, monkeypatch):
    """The parts that a worker reads are set through its environment's module, so the classes are called here."""
    passages = [words(700 + i, 12) for i in range(6)]
    strings = [(words(800 + i, 3) + " " + passages[i % 6]).encode()[:80] for i in range(60)]
    doc = np.arange(60) // 2
    entry, start, stop = suffix_dedup.covered(doc, strings)
    marked = np.zeros((60, 80), dtype=bool)
    for e, a, b in zip(entry.tolist(), start.tolist(), stop.tolist(), strict=True):
        marked[e, a:b] = True
    plain = np.zeros((60, 80), dtype=bool)
    for i, s in enumerate(strings):
        for p in range(len(s) - 49):
            if any(doc[j] < doc[i] and s[p : p + 50] in t for j, t in enumerate(strings)):
                plain[i, p : p + 50] = True
    assert (marked == plain).all()


# --- 10: toxicity ------------------------------------------------------------------------------------------------


def test_toxic_words_are_learned(spark):
    rows = [(i, words(i, 60) + (" vileword" if i % 4 == 0 else "") + " " + words(i + 5000, 30)) for i in range(800)]
    rows += [(9001, None), (9002, ""), (None, "vileword")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"label": F.lit(1), "h": F.lit(2), "score": F.lit(3.0)})
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(600)] + [(None, 1), (3, None), (5, 0)], "doc_id long, toxic int")
    weights = toxicity.train(df, labels, "doc_id", "text", "toxic")
    got = {r["doc_id"]: r["score"] for r in toxicity.score(df, "text", weights).collect()}
    assert len(weights[0]) < 400
    unseen = [i for i in range(600, 800)]
    assert sum((got[i] >= 0.5) == (i % 4 == 0) for i in unseen) >= 195
    assert got[9001] == got[9002] < 0.5 and 0 <= min(got.values()) and max(got.values()) <= 1


def test_ftrl_is_the_plain_one():
    """Against the published update, coordinate by coordinate."""
    rng = np.random.default_rng(3)
    rows = [(np.unique(rng.integers(0, 40, rng.integers(0, 12))), int(rng.integers(0, 2))) for _ in range(300)]
    model, z, n = toxicity.FTRL(40), defaultdict(float), defaultdict(float)

    def weight(i):
        l1, l2 = (0.0, 0.0) if i == "b" else (toxicity.L1, toxicity.L2)
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((toxicity.BETA + math.sqrt(n[i])) / toxicity.ALPHA + l2)

    for slots, y in rows:
        model.learn(slots, y)
        at = [*slots.tolist(), "b"]
        w = {i: weight(i) for i in at}
        g = 1 / (1 + math.exp(-sum(w.values()))) - y
        for i in at:
            z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / toxicity.ALPHA * w[i]
            n[i] += g * g
    assert np.allclose(model.weights(slice(0, -1)), [weight(i) for i in range(40)])
    assert math.isclose(model.intercept(), weight("b"))
    assert any(weight(i) for i in range(40))


def test_training_and_scores_equal_a_plain_run(spark):
    """All of op10's way on a small table: sample, order of visits, weights and scores."""
    rows = [(i, words(i, 25) + (" vileword" if i % 3 == 0 else "")) for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(150)], "doc_id long, toxic int")
    at, weights, intercept = toxicity.train(df, labels, "doc_id", "text", "toxic")
    learned = [(i, t) for i, t in rows if zlib.crc32(str(i).encode()) % 3 != 1]
    hashes = {(r.e, r.doc_id): (r.o, r.h) for r in df.select("doc_id", F.xxhash64(F.lit(10), "doc_id").alias("h"), F.explode(F.sequence(F.lit(1), F.lit(toxicity.EPOCHS))).alias("e")).withColumn("o", F.xxhash64("e", "h")).collect()}
    slots = {i: np.unique(toxicity.features([t])[1]) for i, t in rows}
    model = toxicity.FTRL(1 << toxicity.BITS)
    for epoch in range(1, toxicity.EPOCHS + 1):
        for i, _ in sorted(learned, key=lambda r: hashes[epoch, r[0]]):
            model.learn(slots[i], int(i % 3 == 0))
    w = model.weights(slice(0, -1))
    assert at.tolist() == np.flatnonzero(w).tolist() and np.allclose(weights, w[at])
    assert math.isclose(intercept, model.intercept())
    got = {r.doc_id: r.score for r in toxicity.score(df, "text", (at, weights, intercept)).collect()}
    for i, _ in rows:
        assert math.isclose(got[i], 1 / (1 + math.exp(-(w[slots[i]].sum() + intercept))), rel_tol=1e-4)


def test_labels_of_one_kind_or_none(odd, empty, spark):
    for rows, expected in (([], 0.0), ([(1, 0), (2, 0)], 0.0), ([(i, 1) for i in range(1, 16)], 1.0)):
        labels = spark.createDataFrame(rows, "doc_id long, toxic int")
        weights = toxicity.train(odd, labels, "doc_id", "text", "toxic")
        assert {round(r["p"], 6) for r in toxicity.score(odd, "text", weights, "p").collect()} == {expected}
    assert toxicity.score(empty, "text", weights, "p").count() == 0


def test_held_out_accuracy(spark):
    scored = toxicity.op10_toxicity(spark, "/root/testdata/sf0.1").toPandas()
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").toPandas()
    held = scored[scored.held_out].merge(labels, on="doc_id")
    assert held[held.toxic == 1].predicted.mean() >= 0.65
    assert held[held.toxic == 0].predicted.mean() <= 0.01


def test_brute_force_on_the_smallest_tables(spark, sf_dir):
    rows = texts(spark, sf_dir)
    repeats = suffix_dedup.op9_suffix_dedup(spark, sf_dir).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats) == plain_repeats(rows)
    linked = jaccard_join.op3_jaccard_join(spark, sf_dir).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in linked) == sorted(plain_components(rows))
    assert DOCUMENTS.startswith("doc_id")


def test_chunks_are_bounded_by_bytes():
    import pyarrow as pa

    from tablesift.llm.common import chunks

    texts = [None, "", "ab", "c" * 9, "é", None, "d"]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})
    assert list(chunks(batch, "text", 4)) == [(0, [None, "", "ab"]), (3, ["c" * 9]), (4, ["é", None, "d"])]
    assert [t for _, part in chunks(batch.slice(2), "text", 1) for t in part] == texts[2:]


@pytest.mark.parametrize("texts", [[], [None, ""], [" \t\r\n", "a"], ["A b\x0b\x0cB\x1ca", None, "\x00 é É a a", "", "x " * 5000], ["one"], [" x ", "x", "X\ny"]])
def test_words_of_texts_are_those_of_split(texts):
    found = lm_score.words_of(texts)
    listed = found.listed()
    split = [lm_score.split(t) for t in texts]
    assert [listed[c] for c in found.codes.tolist()] == [w for d in split for w in d]
    assert len(set(listed)) == len(listed)
    assert found.sizes.tolist() == [len(d) for d in split]
    assert found.lengths.tolist() == [len((t or "").encode()) for t in texts]
    assert found.owners().tolist() == [i for i, d in enumerate(split) for _ in d]


def test_escaped_words_met_before_in_their_text():
    code, doc = np.array([4, 2, 4, 4, 2, 9, 2, 2]), np.array([0, 0, 0, 2, 2, 2, 2, 5])
    again, had = lm_score._escaped_before(code, doc)
    assert again.tolist() == [False, False, True, False, False, False, True, False]
    assert had.tolist() == [0, 1, 2, 0, 1, 2, 3, 0]
    assert [len(x) for x in lm_score._escaped_before(code[:0], doc[:0])] == [0, 0]
