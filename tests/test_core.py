"""Operators that SQL can't express against brute force, planted cases and round trips."""

import io
import json
import os
import random
import re
import zipfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lexmill import scale
from lexmill.functions import layout
from lexmill.functions import text as X
from lexmill.operators import decide, draw, graph, learn, lookup, near, search, sections
from lexmill.plans import catalog
from lexmill.sources import readers, sinks
from lexmill.streaming import jobs


def words(rng, n, vocabulary=500):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


class TestScale:
    def test_salted_lookup_equals_a_join(self, spark):
        left = spark.range(1000).select((F.col("id") % 7).alias("k"), "id")
        right = scale.stored(spark.range(5).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v")))
        for how in ("inner", "left"):
            want = sorted(map(tuple, left.join(right, "k", how).select("k", "id", "v").collect()), key=str)
            for limit in (0, 100):
                assert sorted(map(tuple, scale.salted_lookup(left, right, "k", how, limit=limit).select("k", "id", "v").collect()), key=str) == want


    def test_broadcast_goes_by_bytes(self, spark):
        left = spark.range(1000).select((F.col("id") % 7).alias("k"), "id")
        right = scale.stored(spark.range(5).select(F.col("id").alias("k"), F.repeat(F.lit("é"), 1000).alias("t"), F.array(F.struct(F.lit("ab").alias("s"), F.lit(1).alias("n"))).alias("l")))
        assert 10_000 < scale.bytes_of(right) < 11_000 and scale.bytes_of(right.select("k"), 5) == 5 * (8 + scale.ROW_BYTES)
        for limit, salted in ((1000, True), (100_000, False)):
            df = scale.salted_lookup(left, right, "k", limit=limit)
            assert ("_salt" in df._jdf.queryExecution().analyzed().toString()) is salted and df.count() == 715
        assert scale.bytes_of(right.limit(0)) == 0

    def test_scope_deletes(self, spark):
        with scale.scope():
            scale.stored(spark.range(3))
            assert any(x.startswith("stored-") for x in os.listdir(scale.shared_folder(spark)))
        assert not any(x.startswith("stored-") for x in os.listdir(scale.shared_folder(spark)))

    def test_no_local_folder_on_a_cluster(self):
        class Unset:
            def get(self, name, default):
                return default

        class Context:
            master = "spark://x:7077"

        class Session:
            conf, sparkContext = Unset(), Context()

        with pytest.raises(RuntimeError):
            scale.shared_folder(Session())


class TestGraph:
    def test_components(self, spark):
        rng = random.Random(3)
        links = [(i, i + 1) for i in range(50)] + [(1000, 1000 + i) for i in range(1, 70)] + [(rng.randrange(2000, 2060), rng.randrange(2000, 2060)) for _ in range(40)] + [(5, 5), (7, None)]
        parent = {}

        def find(x):
            while parent.setdefault(x, x) != x:
                x = parent[x]
            return x

        for a, b in links:
            if b is not None and a != b:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
        got = {r.v: r.label for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
        assert got == {x: find(x) for x in parent}

    def test_empty(self, spark):
        assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


class TestNear:
    def test_no_pair_is_lost(self, spark):
        rng = random.Random(5)
        docs = []
        for i in range(60):
            base = words(rng, rng.randrange(6, 120))
            docs.append((i * 4, " ".join(base)))
            for k in range(1, 3):
                new = list(base)
                for _ in range(rng.randrange(4)):
                    new[rng.randrange(len(new))] = f"x{rng.randrange(99)}"
                docs.append((i * 4 + k, " ".join(new)))
        docs += [(1000, None), (1001, ""), (1002, "too few")]
        sets = {}
        for i, t in docs:
            w = (t or "").split()
            s = {tuple(w[j : j + 5]) for j in range(len(w) - 4)}
            if s:
                sets[i] = s
        heads = {}
        for i in sorted(sets):
            heads.setdefault(frozenset(sets[i]), i)
        ids = sorted(heads.values())
        want = {(a, b) for a in ids for b in ids if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
        s = near.shingle_sets(spark.createDataFrame(docs, "id long, text string"), "id")
        c = near.classes(s)
        assert {r.key: r["class"] for r in c.collect()} == {i: heads[frozenset(sets[i])] for i in sets}
        got = {(r.a, r.b) for r in near.similar_pairs(s.join(c.filter("key = class").select("key"), "key", "left_semi")).collect()}
        assert got == want and len(want) > 20

    def test_minhash_estimates(self, spark):
        df = spark.createDataFrame([(1, list(range(100))), (2, list(range(20, 120))), (3, [])], "id int, h array<long>").select("id", F.transform("h", lambda x: F.xxhash64(x)).alias("h"))
        r = {x.id: x.m for x in df.select("id", near.minhash("h").alias("m")).collect()}
        assert r[3] is None and 0.4 < sum(a == b for a, b in zip(r[1], r[2], strict=True)) / 64 < 0.9


class TestDecide:
    def test_layers_equal_the_sequence(self, spark):
        rng = random.Random(7)
        nodes = [(i, rng.random(), 100, rng.random() < 0.1) for i in range(60)]
        units = [(a, b, u, 10) for a in range(60) for b in rng.sample(range(60), 3) if a != b for u in range(rng.randrange(1, 10))]
        of = {i: (r, w, ref) for i, r, w, ref in nodes}
        fate = {}
        for i in sorted(of, key=lambda x: -of[x][0]):
            covered = {u for a, b, u, _ in units if a == i and of[b][0] > of[i][0] and not of[b][2] and not of[i][2] and fate[b] != "drop"}
            fate[i] = "keep" if not covered else "drop" if 100 - 10 * len(covered) < 40 else "cut"
        df = spark.createDataFrame(nodes, "id int, rank double, words int, reference boolean")
        o = spark.createDataFrame(units, "low int, high int, unit int, words int")
        got = {r.id: r.fate for r in decide.decide(df, o, F.col("words") - F.col("covered") < 40).collect()}
        assert got == fate and {"keep", "cut", "drop"} <= set(fate.values())

    def test_units_equal_the_sequence(self, spark):
        rng = random.Random(8)
        nodes = [(i, rng.random(), 100, rng.random() < 0.1) for i in range(60)]
        # units 0 and 1 are held by most, the rest by few
        have = {i: {u for u in range(2) if rng.random() < 0.7} | set(rng.sample(range(2, 40), rng.randrange(0, 8))) for i in range(60)}
        of = {i: (r, ref) for i, r, _, ref in nodes}
        want = {}
        for i in sorted(of, key=lambda x: -of[x][0]):
            units = {u for u in have[i] for b in have if u in have[b] and of[b][0] > of[i][0] and not of[b][1] and want[b][0] != "drop"} if not of[i][1] else set()
            covered = 20 * len(units)
            want[i] = ("keep" if not units else "drop" if 100 - covered < 30 else "cut", covered)
        df = spark.createDataFrame(nodes, "id int, rank double, words int, reference boolean")
        h = spark.createDataFrame([(i, u, 20) for i, own in have.items() for u in own for _ in range(2)] + [(None, 1, 20), (999, 1, 20), (1, None, 20)], "id int, unit int, words int")
        got = {r.id: (r.fate, r.covered) for r in decide.decide_units(df, h, F.col("words") - F.col("covered") < 30).collect()}
        assert got == want and {"keep", "cut", "drop"} == {f for f, _ in want.values()}

    def test_copies_of_more_than_six_texts(self, spark, tmp_path):
        from lexmill.plans.dedup import greedy_decide

        spark.createDataFrame([("s", "incoming", 1)], "name string, kind string, priority int").write.parquet(f"{tmp_path}/sources.parquet")
        spark.createDataFrame([(i, "s") for i in range(9)], "doc long, source string").write.parquet(f"{tmp_path}/files.parquet")
        docs = [(i, 300, [1, 2, 3], [100, 100, 100]) for i in range(8)] + [(8, 900, [3, 9], [100, 800])]
        spark.createDataFrame(docs, "num long, words int, hashes array<long>, unit_words array<int>").write.parquet(f"{tmp_path}/docs.parquet")
        got = {r.id: (r.fate, r.covered) for r in greedy_decide(spark, str(tmp_path)).collect()}
        # the longest text stays and covers unit 3; the first copy is cut, the others are covered by both
        assert got == {8: ("keep", 0), 0: ("cut", 100)} | {i: ("drop", 300) for i in range(1, 8)}

    def test_only_lines_of_kept_files_are_taken(self, spark, tmp_path):
        from lexmill.plans.dedup import paragraph_overlap_greedy

        line = lambda k: " ".join(f"w{k}x{i}" for i in range(10))
        of = {"c": range(0, 10), "b": range(4, 13), "a": range(10, 18), "ab": range(20, 24), "aa": range(20, 24), "s": []}
        spark.createDataFrame([(p, "\n".join([*map(line, own), "short line"])) for p, own in of.items()] + [("null", None)], "path string, text string").write.parquet(f"{tmp_path}/files.parquet")
        got = {r.path: (r.n, r.taken, r.duplicate) for r in paragraph_overlap_greedy(spark, str(tmp_path)).collect()}
        # b is a duplicate of the longer c, so a keeps the lines that only b shares with it; of two equal files the first path stays
        assert got == {"c": (10, 0, False), "b": (9, 6, True), "a": (8, 0, False), "aa": (4, 0, False), "ab": (4, 4, True)}


class TestHeadings:
    def test_far_headings_do_not_hide_near_ones(self, spark, tmp_path):
        from lexmill.plans.curation import near_headings

        page = lambda *at: "\n".join({k: v for v, k in at}.get(i, "some text.") for i in range(200))
        one, two, three = "The First Part", "The Second Part", "The Third Part"
        texts = {"a": page((one, 5), (two, 35), (three, 190)), "b": page((two, 100), (one, 110), (three, 3)), "c": page((one, 0), (two, 31), (three, 150)), "d": page((one, 0))}
        spark.createDataFrame([*texts.items(), ("null", None)], "path string, text string").write.parquet(f"{tmp_path}/files.parquet")
        assert [tuple(r) for r in near_headings(spark, str(tmp_path)).collect()] == [("a", "b", 3)]


class TestMendedBreaks:
    def test_language_codes_of_any_form(self, spark, tmp_path, monkeypatch):
        from lexmill.plans import derived

        langs = ["en", "EN", "en-EN", "en_GB", "de", "und", "eng-x", "", None]
        spark.createDataFrame([(i, x, "a text") for i, x in enumerate(langs)] + [(99, "en", None)], "doc_id long, lang string, text string").write.parquet(f"{tmp_path}/documents.parquet")
        monkeypatch.setattr(derived.layout, "mended", lambda df, vocabulary, out: df.withColumn(out, F.lit("mended")))
        assert sorted(r.doc_id for r in derived.mended_breaks(spark, str(tmp_path)).collect()) == [0, 1, 2, 3]


class TestBlocks:
    def test_passage_of_more_than_six_texts(self, spark, tmp_path):
        from lexmill.plans.curation import pair_blocks

        docs = [(i, [1, 2, 0, 50 + i, 3], [100, 100, 0, 400, 100], [100, 200, 200, 600, 700]) for i in range(8)]
        spark.createDataFrame(docs, "num long, hashes array<long>, unit_words array<int>, ends array<int>").write.parquet(f"{tmp_path}/docs.parquet")
        spark.createDataFrame([(f"f{i}", i) for i in range(8)] + [("copy", 0)], "path string, doc long").write.parquet(f"{tmp_path}/files.parquet")
        pairs = [(("s", "f0"), ("s", "f1")), (("s", "copy"), ("s", "f1")), (("s", "f0"), ("s", "copy"))]
        spark.createDataFrame(pairs, "a struct<source:string,path:string>, b struct<source:string,path:string>").write.parquet(f"{tmp_path}/pairs.parquet")
        got = sorted((r.a, r.b, r.from_unit, r.to_unit, r.held, r.words) for r in pair_blocks(spark, str(tmp_path)).collect())
        assert got == [(a, b, *x) for a, b in ((0, 1), (1, 0)) for x in ((1, 2, 200, 200), (5, 5, 100, 100))]


class TestLookup:
    def test_spans(self, spark):
        q = spark.createDataFrame([("a", "one two three four five six seven eight nine ten eleven"), ("b", "nothing of this stands anywhere in the corpus at all"), ("s", "short")], "key string, text string")
        d = spark.createDataFrame([(1, "so one two three four five six seven eight nine it was"), (2, "Two, three four; five six seven eight NINE ten eleven!"), (3, None)], "doc_id int, text string")
        spans, scores = lookup.lookup(q, d)
        assert sorted((r.key, r.from_word, r.words, r.doc_id, r.doc_from) for r in spans.collect()) == [("a", 0, 9, 1, 1), ("a", 1, 10, 2, 0)]
        assert {r.key: (r.words, r.covered) for r in scores.collect()} == {"a": (11, 11), "b": (10, 0)}

    def test_unfinished(self, spark):
        s, p = spark.createDataFrame([(1,), (2,)], "snapshot int"), spark.createDataFrame([("x",), ("y",)], "prompt string")
        done = spark.createDataFrame([(2, "x")], "snapshot int, prompt string")
        assert [tuple(r) for r in lookup.unfinished(s, p, done).collect()] == [(2, "y"), (1, "x"), (1, "y")]


class TestSearchAndLearn:
    def vectors(self, spark, n=240):
        rng = random.Random(1)
        rows = []
        for i in range(n):
            y = int(rng.random() < 0.4)
            rows.append((i, f"r{i % 4}", [rng.gauss(1.6 * y, 1)] + [rng.gauss(0, 1) for _ in range(7)], float(y)))
        return spark.createDataFrame(rows, "k int, room string, v array<double>, y double")

    def test_nearest_in_blocks(self, spark, monkeypatch):
        df = self.vectors(spark).select(F.col("k").alias("vec_id"), F.col("v").alias("embedding"))
        whole = search.nearest(df, df.filter("vec_id % 20 = 0")).collect()
        monkeypatch.setattr(search, "ROW_BLOCK", 37)
        monkeypatch.setattr(search, "QUERY_BLOCK", 5)
        parts = search.nearest(df, df.filter("vec_id % 20 = 0")).collect()
        key = lambda rows: sorted((r["query"], r["rank"], r["neighbour"]) for r in rows)
        assert key(whole) == key(parts) and len(whole) == 120

    def test_planted_signal_and_noise(self, spark):
        df = self.vectors(spark).cache()
        s = learn.leave_one_out(df, "room")
        assert learn.auc(s, []).first().auc > 0.8
        noise = df.withColumn("y", (F.pmod(F.xxhash64("k"), F.lit(2))).cast("double"))
        assert 0.3 < learn.auc(learn.leave_one_out(noise, "room"), []).first().auc < 0.7

    def test_pairs_within_rooms(self, spark):
        df = self.vectors(spark)
        d = learn.differences(df, "room")
        model = learn.fit_logistic(d, intercept=False)
        assert model.stages[-1].intercept == 0 and model.stages[-1].coefficients[0] > 0.5
        assert d.filter("y = 1").count() == d.filter("y = 0").count() > 0

    def test_auc_with_ties_and_one_class(self, spark):
        df = spark.createDataFrame([("a", 1.0, 1), ("a", 1.0, 0), ("a", 0.0, 0), ("b", 1.0, 1)], "g string, score double, y int")
        assert {r.g: r.auc for r in learn.auc(df, ["g"]).collect()} == {"a": 0.75, "b": None}

    def test_permutation(self, spark):
        df = self.vectors(spark).select("k", "room", F.element_at("v", 1).alias("score"), "y")
        r = learn.permutation_p(df, "room", rounds=50).first()
        assert r.real > 1 and r.p < 0.05


class TestSections:
    def test_story_split_keeps_all_lines(self, spark):
        df = spark.createDataFrame([("a", "front\nChapter 1 The Bell\none\n\ntwo\nII\nthree"), ("b", "no heads"), ("c", ""), ("n", None)], "path string, text string")
        rows = sorted((r.path, r.part, r.heading, r.text, r.whole) for r in sections.story_split(df, "path").collect() if r.path == "a")
        assert [r[2] for r in rows] == [None, "Chapter 1 The Bell", "II"] and all(r[4] for r in rows) and rows[1][3] == "Chapter 1 The Bell\none\n\ntwo"

    def test_edges(self, spark):
        body = [" ".join(["word"] * 60) + "." for _ in range(6)]
        ps = ["Skip to the content", "Menu", "Subscribe to us", *body, "Share this", "Comments", "first!", "nice"]
        first, end, why = sections.cut_edges(ps)
        assert ps[first:end] == body and "comments" in why
        assert sections.cut_edges(["Subscribe", "too short to cut"]) == (0, 2, ["refused"])
        assert sections.cut_edges([]) == (0, 0, [])
        assert sections.edges(spark.createDataFrame([("a", None), ("b", "\n".join(ps))], "path string, text string"), "path").count() == 2

    def test_book(self):
        book = "\n".join(["The Long Book", *[f"Chapter {i}" for i in range(1, 8)], "Introduction", "to be read", "Chapter 1", "it was " * 40, "Chapter 2", "and so " * 40])
        kinds = [s["kind"] for s in sections.book_sections(book)]
        assert kinds[0] == "front" and "contents" in kinds and kinds[-2:] == ["story", "story"]


class TestLayout:
    def test_unwrap(self):
        wrapped = "\n\n".join("\n".join(["the quick brown fox jumped over the lazy dog and then went"] * 4 + ["home to its den."]) for _ in range(3))
        out = layout.unwrapped(wrapped)
        assert out.count("\n\n") == 2 and "went home" in out and layout.unwrapped(out) == out
        poem = "\n".join(["short line", "a somewhat longer line of verse", "tiny", "again a longer line of verse,"] * 3)
        assert layout.unwrapped(poem) == poem

    def test_breaks(self):
        vocabulary = {w: 5.0 for w in "the sailor went home again a".split()}
        # words that the vocabulary lacks are left alone
        assert layout.mend_breaks("in one line", {"in": 1.0, "one": 2.0}) == "in one line"
        assert layout.mend_breaks("he sa w it all", {w: 1.0 for w in "he saw it all".split()}) == "he saw it all"
        assert layout.mend_breaks("the sai lor we nt home", vocabulary) == "the sailor went home" or layout.mend_word("sai lor", vocabulary) == "sailor"

    def test_words_tags_quotes_chunks(self, spark):
        assert layout.norm_words("Don’t näive-\nly ＡＢＣ Straße") == ["dont", "naively", "abc", "strasse"]
        df = spark.createDataFrame([("<say>hi</say> x <think>so<say>again</say>",), (None,)], "t string").select(layout.inline_tags("t").alias("t"))
        rows = [r.t for r in df.collect()]
        assert [(x.tag, x.text) for x in rows[0]] == [("say", "hi"), ("think", "so<say>again</say>")] and rows[1] is None
        assert layout.quoted("was so", ["it was so", "other"]) == 0 and layout.quoted("a", ["ab", "ac"]) is None
        text = "\n\n".join(["p" * 50] * 9)
        c = spark.createDataFrame([(text,)], "t string").select(layout.chunks("t", F.lit(120)).alias("c")).first().c
        assert "".join(c) == text and all(len(x) >= 120 for x in c[:-1])

    def test_lottery(self, spark):
        df = spark.range(4000).select(F.col("id").cast("string").alias("s"))
        n = df.filter(X.hash_below(F.col("s"), 0.25)).count()
        assert 850 < n < 1150


class TestDraw:
    def test_mixture_shares(self, spark):
        w = {"a": 3.0, "b": 1.0, "zero": 0.0}
        rows = draw.mixture(spark.range(8000).withColumnRenamed("id", "draw"), w, {"a": 10, "b": 500, "zero": 5}).collect()
        share = sum(r.shelf == "a" for r in rows) / len(rows)
        assert len(rows) == 8000 and 0.73 < share < 0.77 and {r.shelf for r in rows} == {"a", "b"} and max(r.offset for r in rows if r.shelf == "a") == 9

    @pytest.mark.parametrize("bad", ["x", "[1]", '{"c": 1}', '{"a": "1"}', '{"a": -1}', '{"a": 0}', '{"a": NaN}', '{"a": true}'])
    def test_bad_weights(self, bad):
        with pytest.raises(ValueError):
            draw.read_weights(bad, {"a", "b"})

    def test_bag_pots_seats(self, spark):
        bag = draw.shuffle_bag(spark.range(10), 3, "id").collect()
        assert all(sorted(r.id for r in bag if r["round"] == k) == list(range(10)) for k in (1, 2, 3)) and [r.id for r in bag if r["round"] == 1] != [r.id for r in bag if r["round"] == 2]
        pots = draw.two_pots(spark.range(4000).withColumnRenamed("id", "draw"), 30, 10).groupBy("pot").count().collect()
        assert 850 < {r.pot: r["count"] for r in pots}["new"] < 1150
        t = spark.createDataFrame([(1, []), (2, ["b"]), (3, None), (4, ["a", "b", "c"])], "turn int, down array<string>")
        assert [r.seat for r in draw.seats(t, ["a", "b", "c"]).orderBy("turn").collect()] == ["a", "c", "c", None]


class TestSources:
    def test_text_files(self, spark, tmp_path):
        for name, raw in {"a.txt": b"good words", "in/b.txt": "﻿märchen".encode(), "c.md": b"x", "bin.txt": b"a\0b", "bad.txt": b"\xff\xfe\xfa", "none.txt": b" .. "}.items():
            (tmp_path / name).parent.mkdir(exist_ok=True)
            (tmp_path / name).write_bytes(raw)
        rows = {r.path.rsplit("/", 1)[-1]: (r.text, r.reason) for r in readers.read_texts(spark, str(tmp_path)).collect()}
        assert rows == {"a.txt": ("good words", None), "b.txt": ("märchen", None), "bin.txt": (None, "binary"), "bad.txt": (None, "not utf-8"), "none.txt": (None, "no words")}

    def test_glob(self):
        import re

        ok = lambda g, p: bool(re.match(readers.glob_pattern(g), p))
        assert ok("*.txt", "a.txt") and not ok("*.txt", "d/a.txt") and ok("**/*.txt", "d/e/a.txt") and ok("**/*.txt", "a.txt") and ok("?.txt", "a.txt") and not ok("?.txt", "ab.txt")

    def test_jsonl(self, spark, tmp_path):
        p = tmp_path / "x.jsonl"
        p.write_text('{"id": "1", "text": "a"}\n{"id": "2"\n{"id": "3"}\n{"id": "4", "text": " "}\n')
        assert sorted((r.id or "", r.reason or "") for r in readers.read_jsonl(spark, str(p)).collect()) == [("", "bad json"), ("1", ""), ("3", "no text"), ("4", "empty")] or {r.reason for r in readers.read_jsonl(spark, str(p)).collect()} == {None, "bad json", "no text", "empty"}

    def test_listing(self, spark):
        known = spark.createDataFrame([("a", 1, 1), ("b", 2, 2), ("gone", 1, 1)], "path string, size int, mtime int")
        now = spark.createDataFrame([("a", 1, 1), ("b", 3, 2), ("new", 1, 1)], "path string, size int, mtime int")
        assert {r.path for r in readers.changed(now, known).collect()} == {"b", "new"}
        assert [r.path for r in readers.vanished(now, known, True).collect()] == ["gone"] and readers.vanished(now, known, False).count() == 0

    def epub(self):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            z.writestr("mimetype", "application/epub+zip")
            z.writestr("META-INF/container.xml", '<container><rootfiles><rootfile full-path="OPS/p.opf"/></rootfiles></container>')
            z.writestr("OPS/p.opf", '<package><metadata><title>Book</title><creator>Someone</creator></metadata><manifest><item id="n" href="nav.xhtml" properties="nav"/><item id="b" href="b.xhtml"/><item id="a" href="a.xhtml"/></manifest><spine><itemref idref="a"/><itemref idref="b"/></spine></package>')
            z.writestr("OPS/nav.xhtml", '<nav><a href="a.xhtml#x">First <b>one</b></a><a href="b.xhtml">Second</a></nav>')
            z.writestr("OPS/a.xhtml", "<html><head><title>t</title></head><body><h1>One</h1><p>Text &amp; more</p></body></html>")
            z.writestr("OPS/b.xhtml", '<html><body epub:type="appendix"><p>End</p></body></html>')
        return out.getvalue()

    def mobi(self, text):
        packed = text[:20] + bytes([0x80 | 3 >> 5, (3 & 31) << 3 | 0]) + text[23:] if text[20:23] == text[17:20] else b"".join(bytes([1, b]) if b > 127 else bytes([b]) for b in text)
        head = (2).to_bytes(2, "big") + bytes(6) + (1).to_bytes(2, "big") + bytes(6)
        first = 78 + 16 + 2
        table = b"".join(o.to_bytes(4, "big") + bytes(4) for o in (first, first + len(head)))
        return bytes(60) + b"BOOKMOBI" + bytes(8) + (2).to_bytes(2, "big") + table + bytes(2) + head + packed

    def test_palm_pairs(self):
        assert readers.palm_unpacked(b"so " + bytes([0x80, 3 << 3 | 3]) + bytes([0xC0 | 0x21])) == b"so so so  a"

    def test_books(self, spark, tmp_path):
        (tmp_path / "a.epub").write_bytes(self.epub())
        (tmp_path / "b.epub").write_bytes(self.epub()[:150])
        (tmp_path / "c.txt").write_bytes("café".encode("cp1252"))
        (tmp_path / "d.pdf").write_bytes(b"%PDF-1.4 x")
        (tmp_path / "e.mobi").write_bytes(self.mobi(b"<html><h1>Two</h1><p>So so so so it caf\xe9 was</p></html>"))
        import zlib

        content = zlib.compress(rb"BT /F1 12 Tf 72 700 Td (It was \(late\)) Tj 0 -14 Td [(in t) -20 (he) -300 <6E69676874>] TJ ET")
        (tmp_path / "f.pdf").write_bytes(b"%PDF-1.4\n1 0 obj <</Filter/FlateDecode>>\nstream\n" + content + b"\nendstream\nendobj")
        rows = sorted(readers.read_books(spark, str(tmp_path)).collect(), key=lambda r: (r.path, r.n))
        assert [(r.label, r.epub_type, r.heading, r.text, r.author) for r in rows[:2]] == [("First one", None, "One", "One\nText & more", "Someone"), ("Second", "appendix", "", "End", "Someone")]
        assert rows[2].reason.startswith("broken") and rows[3].text == "café" and rows[4].reason == "no text in the PDF"
        assert (rows[5].kind, rows[5].heading, rows[5].text) == ("mobi", "Two", "Two\nSo so so so it café was")
        assert rows[6].text == "It was (late)\nin the night"

    def test_scans(self, spark):
        df = spark.createDataFrame([("b", i, f"THE BOOK {i}\nline of page {i} bro-\nken here\n{i}") for i in range(1, 5)], "book string, page int, text string")
        t = readers.scanned_pages(df).first().text
        assert "THE BOOK" not in t and "broken here" in t and t.count("line of page") == 4

    def test_sinks(self, spark, tmp_path):
        df = spark.createDataFrame([("p", "k", "s", [1, 2, 70])], "path string, kind string, source string, ids array<int>")
        sinks.write_jsonl(df, str(tmp_path / "j"))
        line = spark.read.text(str(tmp_path / "j")).first().value
        assert list(json.loads(line)) == ["ids", "kind", "path", "source"]
        sinks.write_by_kind(df, str(tmp_path / "k"))
        assert spark.read.parquet(str(tmp_path / "k")).first().source == "s"
        m = sinks.write_tokens(df, str(tmp_path / "t")).first()
        assert (m.texts, m.tokens, m.greatest, m.width) == (1, 3, 70, "uint16")
        a, b = sinks.plan_key(df, "path", "ids"), sinks.plan_key(df.withColumn("ids", F.array(F.lit(1))), "path", "ids")
        assert [r.step for r in sinks.convergent(a, a).collect()] == ["untouched"] and [r.step for r in sinks.convergent(a, b).collect()] == ["write"]
        assert [r.step for r in sinks.convergent(a.limit(0), b).collect()] == ["trash"]


class TestStreaming:
    def folder(self, spark, tmp_path):
        rows = [(i, f"2024-01-01 {h:02}:{m:02}:00", i % 3, ("view", "error")[i % 2], float(i), None) for i, (h, m) in enumerate([(0, 5), (0, 20), (0, 50), (1, 10), (1, 30), (2, 5), (2, 10), (5, 0), (0, 1), (6, 0), (6, 1), (6, 5)])]
        df = spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double, props string").withColumn("ts", F.to_timestamp("ts"))
        for k in range(3):
            df.filter((F.col("event_id") >= 4 * k) & (F.col("event_id") < 4 * k + 4)).coalesce(1).write.mode("append").parquet(str(tmp_path / "e"))
        return df, str(tmp_path / "e")

    def test_late_rows_are_dropped(self, spark, tmp_path):
        df, folder = self.folder(spark, tmp_path)
        got = {(r.start.hour, r.event_type): r.n for r in jobs.run_once(jobs.tumbling(jobs.read_events(spark, folder))).collect()}
        # row 8 of 00:01 comes when the watermark is past its window
        assert got[0, "view"] == 2 and got[0, "error"] == 1

    def test_state_survives_batches(self, spark, tmp_path):
        df, folder = self.folder(spark, tmp_path)
        rows = jobs.run_once(jobs.count_windows(jobs.read_events(spark, folder), 2)).collect()
        assert sorted((r.user_id, r.batch, r.n) for r in rows) == [(u, b, 2) for u in range(3) for b in (1, 2)] and sum(r.total for r in rows) == sum(range(12))
        assert jobs.run_once(jobs.turn_sessions(jobs.read_events(spark, folder), 4)).count() == 3

    def test_mirror_and_feed(self, spark, tmp_path):
        df, folder = self.folder(spark, tmp_path)
        jobs.mirror(jobs.read_events(spark, folder), str(tmp_path / "m")).awaitTermination()
        last = max(int(p.name) for p in (tmp_path / "m").iterdir() if p.name.isdigit())
        assert sum(p.name.isdigit() for p in (tmp_path / "m").iterdir()) <= 2
        got = {r.user_id: r.event_id for r in spark.read.parquet(str(tmp_path / "m" / str(last))).collect()}
        assert got == {0: 9, 1: 10, 2: 11}
        old, new = (jobs.digests(df.filter(f"event_id < {n}"), "user_id", "event_id", "event_type") for n in (10, 12))
        assert sorted(r.user_id for r in jobs.feed(new, old, "user_id").collect()) == [1, 2]

    def test_repeats_and_sessions(self, spark, tmp_path):
        df, folder = self.folder(spark, tmp_path)
        df.filter("event_id = 3").coalesce(1).write.mode("append").parquet(folder)
        assert jobs.run_once(jobs.without_repeats(jobs.read_events(spark, folder, 10), "10 hours")).count() == 12
        assert jobs.run_once(jobs.sessions(jobs.read_events(spark, folder, 10), "30 minutes")).count() > 0
        assert jobs.run_once(jobs.followed(jobs.read_events(spark, folder, 10), within="60 minutes")).columns == ["a_id", "b_id"]


class TestSettle:
    def test_headings_and_introductions_go_with_a_cut(self):
        from lexmill.operators.settle import settle

        units = [(300, False, "a story"), (40, False, "The editor speaks of the Bell here"), (3, True, "The Bell"), (2, True, "by Someone"), (1200, False, "x"), (300, False, "next"), (2, True, "Alone"), (500, False, "y")]
        assert settle(units, [(4, 5)]) == ([(0, 2), (5, 8)], [])
        assert settle([units[1], *units[2:]], [(3, 4)], container=True) == ([(4, 7)], [])
        assert settle(units, [(4, 6), (7, 8)]) == ([(0, 2)], [(6, 7)])
        assert settle(units, []) == ([(0, 8)], []) and settle([], [(0, 3)]) == ([], [])

    def test_table(self, spark):
        from lexmill.operators.settle import settled

        df = spark.createDataFrame([(1, [(100, False, "x"), (5, False, None)], [(0, 1)], None), (2, None, None, False)], "num int, units array<struct<words:int,heading:boolean,text:string>>, cuts array<struct<a:int,b:int>>, container boolean")
        assert {r.num: (r.keep, r.remnants) for r in settled(df).collect()} == {1: ([[1, 2]], []), 2: ([], [])}

    def test_fan_texts(self, spark):
        from lexmill.operators.settle import cleaned_fan_texts, fan_clean

        assert fan_clean("Disclaimer: not mine\nRating: T\n\nIt began.\n---\n-----\nIt went on.\nA/N: please review") == "It began.\n* * *\nIt went on."
        assert fan_clean("") == "" and cleaned_fan_texts(spark.createDataFrame([("a", None)], "path string, text string"), "path").first().text is None

    def test_spaced_and_paths(self, spark):
        from lexmill.operators.settle import first_seen_paths, longest_prefixes, spaced

        df = spark.createDataFrame([("f", x) for x in (1, 5, 12, 14, 20, 40, 41)] + [("g", 3)], "file string, line int")
        assert sorted((r.file, r.line) for r in spaced(df, "file", "line", 12).collect()) == [("f", 1), ("f", 14), ("f", 40), ("g", 3)]
        p = spark.createDataFrame([("t", "a", [1, 2, 3]), ("t", "b", [1, 2, 4, 5]), ("t", "c", [1, 2])], "tree string, path string, nodes array<int>")
        assert {r.path: r.new for r in first_seen_paths(p).collect()} == {"b": [1, 2, 4, 5], "a": [3]}
        assert longest_prefixes(["A", "B", "x", "A"], {"A": "a", "A, B": "ab"}) == ["ab", "a"]


class TestTree:
    def test_depths(self, spark):
        from lexmill.operators import tree

        rows = [(1, None), (2, 1), (3, 2), (4, 3), (5, 99), (6, 5), (7, 8), (8, 7)]
        got = {r.id: (r.root, r.depth) for r in tree.depths(spark.createDataFrame(rows, "id int, parent int")).collect()}
        assert got == {1: (1, 0), 2: (1, 1), 3: (1, 2), 4: (1, 3), 5: (5, 0), 6: (5, 1)}
        assert sorted(r.id for r in tree.leaves(spark.createDataFrame(rows[:4], "id int, parent int")).collect()) == [4]


class TestContainment:
    def test_no_pair_is_lost(self, spark):
        rng = random.Random(12)
        docs = [(i, " ".join(words(rng, rng.randrange(5, 90)))) for i in range(40)]
        for i in range(40, 80):
            a, b = rng.choice(docs[:40])[1].split(), rng.choice(docs[:40])[1].split()
            k = rng.randrange(1, len(a) + 1)
            docs.append((i, " ".join(b[: len(b) // 2] + a[:k] + b[len(b) // 2 :])))
        sets = {}
        for i, t in docs:
            w = t.split()
            s = frozenset(tuple(w[j : j + 5]) for j in range(len(w) - 4))
            if s and s not in sets.values():
                sets[i] = s
        want = {(a, b) for a in sets for b in sets if a != b and (len(sets[a]), a) < (len(sets[b]), b) and len(sets[a] & sets[b]) >= 0.8 * len(sets[a])}
        df = spark.createDataFrame([(i, t) for i, t in docs if i in sets], "id int, text string")
        got = {(r.small, r.large) for r in near.contained_pairs(near.shingle_sets(df, "id")).collect()}
        assert got == want and len(want) > 15

    @staticmethod
    def brute(texts):
        sets = {}
        for i, t in sorted(texts.items()):
            w = re.findall(r"[^\W_]+", (t or "").lower())
            s = frozenset(tuple(w[j : j + 5]) for j in range(len(w) - 4))
            if s and s not in sets.values():
                sets[i] = s
        return {(a, b) for a in sets for b in sets if (len(sets[a]), a) < (len(sets[b]), b) and len(sets[a] & sets[b]) >= 0.8 * len(sets[a])}

    def test_stores_and_broadcasts_little(self, spark, tmp_path, monkeypatch):
        """Texts that share half of their runs, few of which lie in one another: neither sets nor shared runs are stored whole or go to the driver."""
        rng = random.Random(3)
        new = lambda n: " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(n))
        texts = {}
        for i in range(0, 240, 2):
            half = new(200)
            texts |= {i: f"{half} {new(210)}", i + 1: f"{new(205)} {half}"}
        texts |= {500: texts[0].upper() + "!", 501: " ".join(texts[7].split()[:60]), 502: "one two three four", 503: None, 504: "", 505: " ".join(texts[9].split()[3:8])}
        spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
        size, seen = (lambda at: sum(p.stat().st_size for p in at.rglob("*.parquet"))), []
        asked = scale.bytes_of
        monkeypatch.setattr(scale, "bytes_of", lambda *a, **k: seen.append(asked(*a, **k)) or seen[-1])
        folder = Path(scale.shared_folder(spark))
        before = size(folder)
        got = {(r.small, r.large) for r in catalog.queries()["pair_containment"](spark, str(tmp_path)).collect()}
        assert got == self.brute(texts) == {(501, 7), (505, 9)}
        assert seen and max(seen) < 0.05 * size(tmp_path)
        assert size(folder) - before < 2 * size(tmp_path)
        assert [tuple(r) for r in catalog.queries()["contained_losers"](spark, str(tmp_path)).orderBy("doc_id").collect()] == [(501, 7), (505, 9)]

    def test_run_of_many_texts(self, spark):
        """A run that more texts have than fit in a block of holders."""
        rng = random.Random(8)
        phrase = " ".join(f"p{i}" for i in range(9))
        texts = {i: f"{' '.join(words(rng, 12))} {phrase}" for i in range(620)} | {700: phrase, 701: f"{phrase} {phrase.split()[0]}", 702: "Ünder " + phrase.title()}
        sets = near.squeezed(spark.createDataFrame(list(texts.items()), "id long, text string"), "id")
        got = {(r.small, r.large) for r in near.contained_pairs(sets.join(near.copies(scale.stored(near.digests(sets))), "key", "left_anti")).collect()}
        assert got == self.brute(texts) and len([a for a, _ in got if a == 700]) > near.PAIR_BLOCK

    def test_empty(self, spark):
        none = near.squeezed(spark.createDataFrame([(1, None), (2, "a b")], "id long, text string"), "id")
        assert near.contained_pairs(none).collect() == []


class TestRanges:
    def test_numbers_and_carried_values(self, spark):
        rng = random.Random(4)
        rows = [(rng.choice(["hot"] * 6 + ["a", None]), i, rng.choice([None, None, i])) for i in rng.sample(range(900), 500)]
        df = spark.createDataFrame(rows, "g string, t int, v int")
        seen, want_k, want_v = {}, {}, {}
        for g, t, v in sorted(rows, key=lambda r: (str(r[0]), r[1])):
            n, last = seen.get(g, (0, None))
            last = v if v is not None else last
            seen[g] = (n + 1, last)
            want_k[t], want_v[t] = n + 1, last
        assert {r.t: r.k for r in scale.numbered(df, ["g"], ["t"]).collect()} == want_k
        some = df.filter("g IS NOT NULL")
        assert {r.t: r.last for r in scale.carried(some, ["g"], ["t"], F.col("v"), "last").collect()} == {t: want_v[t] for g, t, _ in rows if g}
        assert scale.numbered(df.limit(0), ["g"], ["t"]).count() == 0
