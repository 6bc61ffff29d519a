"""Tests of the llm operators: brute force on small fixtures, exact round trips, and the defined results for odd input."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexmill import scale
from lexmill.llm import bytepair, canonical, encode, groups, leaks, markup, mixture, mojibake, shared_spans, site_lines, token_budget

DATA = "/root/testdata/sf0.001"
ODD = ["", " ", "\n\n", "a" * 5000, "0" * 3001, "\x1c\x1d a\x85b　c", "<|endoftext|> x", "don't'll  \n\n x", "🙂👩‍👧é́日本" * 40, "x\r\ny\t\tz"]


def words(rng, n, vocabulary=4000):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="module")
def tokenizer():
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(bytepair.vocabulary_path())
    t.encode_special_tokens = True
    return lambda texts: [x.ids for x in t.encode_batch(texts, add_special_tokens=False)]


class TestTokens:
    def texts(self):
        rng = random.Random(3)
        return ODD + ["".join(rng.choice("aeé ‍\n🙂日本x1.'s") for _ in range(200)) for _ in range(200)]

    def test_prefix_encoding_equals_the_library(self, spark, tokenizer):
        texts = self.texts()
        df = spark.createDataFrame([*enumerate(texts), (-1, None), (0, texts[0])], "doc_id long, text string")
        rows = encode.encode_texts(df).collect()
        want = tokenizer(texts)
        assert len(rows) == len(texts) + 2
        assert all(r.ids == (want[r.doc_id] if r.doc_id >= 0 else []) for r in rows)

    def test_merge_rounds_count_the_same(self, spark, tokenizer):
        texts = self.texts()
        df = spark.createDataFrame([*enumerate(texts), (-1, None)], "doc_id long, text string").withColumn("tokens", F.lit("clash"))
        want = tokenizer(texts)
        assert all(r.tokens == (len(want[r.doc_id]) if r.doc_id >= 0 else 0) for r in token_budget.count_tokens(df).collect())

    def test_append_and_edit(self, tokenizer):
        voc = bytepair.vocabulary(bytepair.vocabulary_path())
        enc = bytepair.PrefixEncoder(voc)
        piece = "internationalisation".encode()
        last = enc.extend(piece[:7])
        assert enc.tokens_of(enc.extend(piece, list(last))) == enc.encode(piece)
        rng = random.Random(1)
        text = " ".join(words(rng, 60)) + "  \n it's done.  "
        e = bytepair.Edited(text)
        for _ in range(60):
            a = rng.randrange(len(e.text) + 1)
            b = min(len(e.text), a + rng.randrange(4))
            new = "".join(rng.choice("ab '\n1 s") for _ in range(rng.randrange(4)))
            again = e.replace(a, b, new)
            assert e.ids == tokenizer([e.text])[0]
            assert "".join(e.pieces) == e.text
        assert again < 12

    def test_empty_table(self, spark):
        df = spark.createDataFrame([], "doc_id long, text string, ids int")
        assert encode.encode_texts(df).columns == ["doc_id", "ids"] and encode.encode_texts(df).count() == 0

    def test_budget_adds_up(self, spark):
        df = spark.createDataFrame([("a", "en", "one two"), ("a", "en", None), (None, "en", "x"), ("a", None, "")], "source string, lang string, text string")
        rows = {(r.source, r.lang): (r.texts, r.tokens) for r in token_budget.token_budget(df, ["source", "lang"]).collect()}
        assert rows == {("a", "en"): (2, 2), (None, "en"): (1, 1), ("a", None): (1, 0)}

    def test_language_style(self, spark):
        df = spark.createDataFrame([(x,) for x in ("en", "EN", "en-US", "en_x", "Deutsch", "", " ", None, "français")], "l string")
        assert [r[0] for r in df.select(token_budget.language_code(F.col("l"))).collect()] == ["en", "en", "en", "en", "de", None, None, None, "fr"]


class TestSiteLines:
    def test_against_brute_force(self, spark):
        rng = random.Random(5)
        rows = []
        for s, n in (("hot", 300), ("b", 40), (None, 12)):
            for i in range(n):
                lines = [" ".join(words(rng, 8)) for _ in range(4)]
                if rng.random() < 0.5:
                    lines.insert(rng.randrange(4), f"  READ issue {rng.randrange(99)} of the   paper")
                if rng.random() < 0.04:
                    lines.append("rare notice in here")
                if i % 3 == 0:
                    lines.append("two words")
                rows.append((s, f"{s}/{i}", "\n".join(lines)))
        rows += [("hot", "hot/null", None), ("hot", "hot/empty", "")]
        df = spark.createDataFrame(rows, "source string, path string, text string").withColumn("template", F.lit(1))
        seen, of = {}, {}
        for s, p, t in rows:
            if t:
                of[s] = of.get(s, 0) + 1
                for n, line in enumerate(t.split("\n"), 1):
                    k = site_lines.template_of(line)
                    if k:
                        seen.setdefault((s, tuple(k)), set()).add((p, n))
        want = {x for (s, _), v in seen.items() for x in v if len({p for p, _ in v}) >= 5 and len({p for p, _ in v}) >= 0.02 * of[s]}
        got = [(r.path, r.line_no) for r in site_lines.repeated_lines(df.repartition(7)).collect()]
        assert len(got) == len(set(got)) and set(got) == want and want
        clean = {r.path: r for r in site_lines.without_repeated_lines(df).collect()}
        assert len(clean) == len(rows) and clean["hot/null"].text is None and clean["hot/empty"].text == ""
        assert all(r.removed == sum(p == r.path for p, _ in want) for r in clean.values())

    def test_empty_table(self, spark):
        df = spark.createDataFrame([], "source string, path string, text string")
        assert site_lines.repeated_lines(df).count() == 0

    def test_similar_lines_share_a_template(self):
        def grown(*lines):
            trees = site_lines.Trees()
            for line in lines:
                tokens = site_lines.template_of(line)
                trees.add("s", {site_lines.digest(tokens): (site_lines.leaf_of(tokens), tokens)})
            (*_, templates, files) = trees.emit()
            return list(zip(templates, files, strict=True))

        one = grown("Story 12 by Anna posted on our site", "story 7 by Boris posted on our site", "Story 3 by Boris posted on our site")
        assert one == [(["story", "0", "by", None, "posted", "on", "our", "site"], 3)]
        two = grown("story 8 by Anna posted on our wall")
        assert site_lines.merge(one + two) == [(["story", "0", "by", None, "posted", "on", "our", None], 4)]
        other = grown("story 8 by no one you could know")
        assert sorted(n for _, n in site_lines.merge(one + other)) == [1, 3]
        # what one line could fit is one template, though few tokens are equal
        assert site_lines.merge([(["a", "b", "c", "d", None, None, None], 2), (["a", "b", "c", None, "e", "f", "g"], 1)]) == [(["a", "b", "c", None, None, None, None], 3)]

    def test_templates_lose_no_line(self, spark):
        rng = random.Random(11)
        rows = []
        for i in range(240):
            lines = [f"read more stories {' '.join(rng.choice('aaaab') for _ in range(rng.randrange(1, 6)))}" for _ in range(rng.randrange(5))]
            # more unlike lines than a leaf has templates
            unlike = [f"read more stories {' '.join(''.join(rng.choices('ghijk', k=3)) for _ in range(5))}" for _ in range(4)]
            rows.append((rng.choice(["x", "x", "y", None]), f"p{i}", "\n".join([*lines, *unlike, f"own words of {i * 'a'}"])))
        seen, of = {}, {}
        for s, p, t in rows:
            of[s] = of.get(s, 0) + 1
            for n, line in enumerate(t.split("\n"), 1):
                seen.setdefault((s, line), set()).add((p, n))
        least = 5
        want = {x for (s, line), v in seen.items() for x in v if len({p for p, _ in v}) >= max(least, 0.02 * of[s])}
        df = spark.createDataFrame(rows, "source string, path string, text string").repartition(5)
        lines, templates, _ = site_lines.site_templates(df)
        got = [(r.path, r.line_no) for r in site_lines.repeated_lines(df).collect()]
        assert len(got) == len(set(got)) and set(got) == want and 0 < len(want) < lines.count()
        kept = templates.collect()
        assert any(None in r.template for r in kept) and all(r.files >= max(least, 0.02 * r.of) for r in kept)
        by_leaf = {}
        for r in kept:
            by_leaf.setdefault((r.source, bytes(r.leaf)), []).append(r.template)
        fits = lambda t, k: all(x is None or x == y for x, y in zip(t, k, strict=True))
        for (s, line), v in seen.items():
            k = site_lines.template_of(line)
            n = sum(fits(t, k) for t in by_leaf.get((s, site_lines.leaf_of(k)), ()))
            assert n <= 1 and (n == 1 or not v & want)

    def test_words_and_case_as_defined(self):
        assert site_lines.template_of("① ② ½ Ⅷ") is None and site_lines.template_of("a² b") is None and site_lines.template_of("a²b c") == ["a²b", "c"]
        assert site_lines.template_of("ΟΔΟΣ İki a") == ["οδοσ", "iki", "a"] != site_lines.template_of("οδος iki a")


class TestCanonical:
    @pytest.mark.parametrize(
        ("text", "form", "why"),
        [
            ("plain “text” – all… fine", None, []), ("Привет, мир; χαῖρε", None, []), ("👩‍👧 ⚓️ 1️⃣", None, []), ("a\tb\r\nc", None, []),
            ("ｆｕｌｌ ﬁne 𝐛old", "full fine bold", ["compatibility"]), ("café na\u0308h", "café näh", ["accent"]),
            ("zero\u200bwidth\ufeff so\u00adft", "zerowidth soft", ["invisible"]), ("no\u00a0break\u2003em", "no break em", ["space"]),
            ("pаypаl", "paypal", ["script"]), ("Москвa", "Москва", ["script"]), ("x²", "x2", ["compatibility"]), ("a‍b", "ab", ["invisible"]),
        ],
    )
    def test_cases(self, text, form, why):
        found = set()
        got = canonical.consistent(text, found)
        assert got == (text if form is None else form) and sorted(found) == why

    def test_idempotent_and_composed(self):
        import unicodedata

        rng = random.Random(2)
        pool = "aeéñüß ÀеаοＡ１ﬁ\u0301\u0308\u0327\u200b\u00a0👩‍️5#\n한각"
        for _ in range(2000):
            t = "".join(rng.choice(pool) for _ in range(12))
            once = canonical.consistent(t)
            assert canonical.consistent(once) == once and unicodedata.is_normalized("NFC", once)

    def test_table(self, spark):
        df = spark.createDataFrame([(1, None), (2, ""), (3, "é" * 100_000), (3, "ok")], "doc_id long, text string").withColumn("needed", F.lit(0))
        rows = canonical.canonical(df, reasons="needed").collect()
        assert [(r.doc_id, r.needed) for r in rows] == [(1, []), (2, []), (3, []), (3, [])] and rows[0].text is None


class TestLeaks:
    def test_against_brute_force(self, spark):
        rng = random.Random(11)
        items = [(f"k{i}", " ".join(words(rng, rng.choice((10, 15, 40, 300)), 60))) for i in range(40)]
        docs = []
        for i in range(300):
            w = words(rng, rng.choice((3, 20, 200, 900)), 60)
            if rng.random() < 0.5:
                other = rng.choice(items)[1].split()
                n = rng.choice((14, 15, 16, 60))
                a = rng.randrange(max(1, len(other) - n))
                w[len(w) // 2 : len(w) // 2] = other[a : a + n]
            docs.append((i, ("  " if i % 2 else ", ").join(w).upper()))
        docs += [(900, None), (901, "")]
        grams = {}
        for k, t in items:
            w = leaks.words_of(t)
            for j in range(len(w) - 14):
                grams.setdefault(tuple(w[j : j + 15]), set()).add(k)
        want = set()
        for i, t in docs:
            w = leaks.words_of(t or "")
            for j in range(len(w) - 14):
                want |= {(k, i) for k in grams.get(tuple(w[j : j + 15]), ())}
        d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("key", F.lit("clash"))
        got = [(r.key, r.doc_id) for r in leaks.leaked_items(d, spark.createDataFrame([*items, ("n", None)], "key string, text string")).collect()]
        assert len(got) == len(set(got)) and set(got) == want and len(want) > 50

    def test_wand_finds_all_above_threshold(self):
        rng = random.Random(4)
        texts = [leaks.hashed_words(" ".join(words(rng, 60, 12))) for _ in range(300)]
        runs = [shared_spans.run_hashes(w, leaks.TERM).tolist() for w in texts]
        many = {}
        for r in runs:
            for t in set(r):
                many[t] = many.get(t, 0) + 1
        index = leaks.Index(leaks.pack([*range(300)], texts, {t: n for t, n in many.items() if n > 1}, 300, 56.0, 6), 6)
        place = {t: n for n, t in enumerate(index.a["terms"].tolist())}
        assert place.keys() == many.keys()
        for n, t in enumerate(index.a["terms"].tolist()):
            own = index.a["post_item"][index.a["ends"][n] : index.a["ends"][n + 1]].tolist()
            assert own == [k for k, r in enumerate(runs) if t in r]
        weights = [{} for _ in runs]
        for n, t in enumerate(index.a["terms"].tolist()):
            for x in range(index.a["ends"][n], index.a["ends"][n + 1]):
                weights[index.a["post_item"][x]][t] = float(index.a["post_weight"][x])
        for k, r in enumerate(runs):  # never above the least weight of a run of six words
            assert index.a["threshold"][k] <= min(sum(weights[k][t] for t in set(r[i : i + 2])) for i in range(len(r) - 1))
        for _ in range(50):
            terms = {place[t] for t in shared_spans.run_hashes(leaks.hashed_words(" ".join(words(rng, 40, 12))), leaks.TERM).tolist() if t in place}
            scores = {}
            for n in terms:
                for x in range(index.a["ends"][n], index.a["ends"][n + 1]):
                    scores[int(index.a["post_item"][x])] = scores.get(int(index.a["post_item"][x]), 0) + float(index.a["post_weight"][x])
            assert sorted(index.search(sorted(terms))) == sorted(n for n, x in scores.items() if x >= max(index.a["threshold"][n], index.lowest))

    def test_parts_and_equal_texts(self, spark):
        """Many parts give the rows of one; items of one text are one item with many keys, repeated items give one row."""
        rng = random.Random(12)
        texts = [" ".join(words(rng, 40, 300)) for _ in range(30)]
        items = [(f"k{i}", t) for i, t in enumerate(texts)] + [(f"copy{i}", texts[0]) for i in range(400)] + [("k3", texts[3]), (None, texts[4])]
        docs = [(i, " ".join(words(rng, 50)) + " " + " ".join(texts[i % 40].split()[5 : 5 + rng.choice((14, 15, 30))] if i % 40 < 30 else [])) for i in range(200)]
        d, h = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "key string, text string").repartition(3)
        one = sorted(map(tuple, leaks.leaked_items(d, h).collect()), key=str)
        assert one == sorted(map(tuple, leaks.leaked_items(d, h, part_words=100).collect()), key=str)
        want = set()
        for i, t in docs:
            w = t.split()
            for k, x in items:
                v = x.split()
                if {tuple(w[j : j + 15]) for j in range(len(w) - 14)} & {tuple(v[j : j + 15]) for j in range(len(v) - 14)}:
                    want.add((k, i))
        assert len(one) == len(set(one)) and set(one) == want and any(k is None for k, _ in want)

    def test_empty_tables(self, spark):
        none = spark.createDataFrame([], "key string, text string")
        assert leaks.leaked_items(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), none).count() == 0
        assert leaks.leaked_items(none.select(F.lit(1).alias("doc_id"), "text"), spark.createDataFrame([("k", "w " * 20)], "key string, text string")).count() == 0


class TestSpans:
    def test_against_brute_force(self, spark):
        rng = random.Random(8)
        end = lambda w: w + rng.choice(("", "", "", ".", "!”"))
        shared = [[end(w) for w in words(rng, n)] for n in (49, 50, 51, 80, 200, 45)]
        docs = []
        for i in range(160):
            w = [end(x) for x in words(rng, rng.choice((5, 60, 300)))]
            for _ in range(rng.randrange(3)):
                p = rng.choice(shared)
                a = rng.randrange(6)
                at = rng.randrange(len(w) + 1)
                w[at:at] = p[a:] if rng.random() < 0.5 else p
            docs.append((i, rng.choice((" ", "\n", "  ")).join(w)))
        docs += [(500, None), (501, ""), (3, docs[3][1])]
        runs = {}
        for i, t in docs:
            w = (t or "").split()
            for j in range(len(w) - 49):
                runs.setdefault(" ".join(w[j : j + 50]), set()).add(i)
        want = {(a, b) for v in runs.values() for a in v for b in v if a < b}
        df = spark.createDataFrame(docs, "num long, text string").withColumn("anchor", F.lit(1))
        got = [(r.num_a, r.num_b) for r in shared_spans.shared_pairs(df).collect()]
        assert len(got) == len(set(got)) and set(got) == want and len(want) > 100
        inside = {}
        for i, t in docs:
            w = (t or "").split()
            own = np.zeros(len(w), bool)
            for j in range(len(w) - 49):
                if len(runs[" ".join(w[j : j + 50])]) > 1:
                    own[j : j + 50] = True
            inside[i] = int(own.sum())
        assert all(r.shared == inside[r.num] for r in shared_spans.shared_words(df.dropDuplicates(["num"])).collect())

    def test_repetitive_text_and_hot_passage(self, spark):
        hot = " ".join(f"p{i}" for i in range(55))
        docs = [(i, f"x{i} " * 60 + hot + f" y{i}") for i in range(60)] + [(100, "same " * 500), (101, "same " * 70), (102, "short")]
        got = {(r.num_a, r.num_b) for r in shared_spans.shared_pairs(spark.createDataFrame(docs, "num long, text string")).collect()}
        assert got == {(a, b) for a in range(60) for b in range(a + 1, 60)} | {(100, 101)}

    def test_empty_table(self, spark):
        assert shared_spans.shared_pairs(spark.createDataFrame([], "num long, text string")).count() == 0


class TestGroups:
    def brute(self, pairs):
        parent = {}

        def find(x):
            while parent.setdefault(x, x) != x:
                x = parent[x]
            return x

        for a, b in pairs:
            if a is not None and b is not None and a != b:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
        return {x: find(x) for x in parent}

    def test_chains_stars_and_webs(self, spark):
        rng = random.Random(6)
        pairs = [(f"c{i:03}", f"c{i + 1:03}") for i in range(60)] + [("hub", f"leaf{i}") for i in range(80)]
        pairs += [(f"r{rng.randrange(90)}", f"r{rng.randrange(90)}") for _ in range(60)]
        pairs += [(b, a) for a, b in pairs[:20]] + pairs[:5] + [("self", "self"), ("n", None), (None, "n")]
        df = spark.createDataFrame(pairs, "a string, b string").withColumn("record", F.lit(1))
        rows = groups.linked_groups(df).collect()
        assert len(rows) == len({r.record for r in rows}) and {r.record: r.group for r in rows} == self.brute(pairs)

    def test_levels_and_hot_vertices(self, spark):
        """Without a last task for few edges and with split vertices the groups are the same."""
        rng = random.Random(16)
        pairs = [(f"c{i:04}", f"c{i + 1:04}") for i in range(700)] + [("hub", f"leaf{i}") for i in range(300)] + [("hub", "c0005"), ("hub", "other")] + [("other", f"far{i}") for i in range(200)]
        pairs += [(f"r{rng.randrange(500)}", f"r{rng.randrange(500)}") for _ in range(260)]
        df = spark.createDataFrame(pairs, "a string, b string")
        for limits in ({"base": 0}, {"base": 0, "hot": 40}, {"base": 300, "hot": 40}):
            rows = groups.linked_groups(df, **limits).collect()
            assert len(rows) == len({r.record for r in rows}) and {r.record: r.group for r in rows} == self.brute(pairs)

    def test_edges_are_shuffled_once_for_all_rounds(self, spark, monkeypatch):
        edges = scale.stored(spark.range(5000).select((F.col("id") * 2).alias("u"), (F.col("id") * 2 + 2).alias("v")))
        monkeypatch.setattr(groups, "stored", lambda df: df)
        state = groups._grow(edges, 0)
        assert len(state.collect()) == 5001
        plan = state._jdf.queryExecution().executedPlan().toString()
        rounds = groups.MOST_SHIFT - 2
        assert plan.count("ReusedExchange") >= rounds - 1

    def test_empty_table(self, spark):
        assert groups.linked_groups(spark.createDataFrame([], "a string, b string")).count() == 0


class TestMarkup:
    @pytest.mark.parametrize(("kind", "sign"), [("wiki", "''"), ("wiki", "'''"), ("markdown", "*"), ("markdown", "**"), ("markdown", "_"), ("markdown", "~~")])
    def test_emphasis_over_a_paragraph(self, kind, sign):
        long, lines = "It was the captain's word " * 40 + "then", "\n".join(["It was the captain's word"] * 5)
        for body in (long, lines):
            text = f"Before.\n\nSo {sign}{body}{sign} it went.\n\nAfter."
            assert markup.kinds_of(text) == [kind]
            clean, kinds = markup.clean_text(text)
            assert kinds == [kind] and sign not in clean.replace("captain's", "") and clean.count("captain's word") == text.count("captain's word")
        # a blank line ends the paragraph
        assert markup.kinds_of(f"So {sign}it went\n\nand ended{sign} here") == []

    @pytest.mark.parametrize(
        ("text", "kinds"),
        [
            ("He <em>ran</em>", ["html"]), ("caf&eacute; &amp;ldquo;x", ["html"]), ("the end</p", ["html"]), ("I <3 ravens; tin < copper and salt > 45", []),
            ("P&L, R&D, Q&A; cost $5 and $7", []), ("C:\\dock\\new\\roof.txt, next to parlour_sister_5", []), ("* * *\n\n***\n\n#\n\n~\n\n----", []), ("- one\n- two", []),
            ("Her sum was 3 * 1 * 2 = 41", []), ("[laughs] He said [sic] {so}", []), ("x^2 or ~9", []), ("    LET a = 1\n    GOTO 10", []), ("1. Find it. 2. Leave -> never :-> (see note *)", []),
            ("Title\n=====\ntext", ["markdown"]), ("## Title", ["markdown"]), ("so **bold** and _fine_", ["markdown"]), ("a [link](/x/1)", ["markdown"]), ("```\ncode\n```", ["markdown"]),
            ("| a | b |\n|---|---|\n| 1 | 2 |", ["markdown"]), ("== Head ==", ["wiki"]), ("a ''slanted'' word", ["wiki"]), ("[[x|y]] {{citation needed}}", ["wiki"]), ("{|\n|-\n| a\n|}", ["wiki"]),
            ("\\emph{x} y", ["latex"]), ("$\\frac{a}{b}$", ["latex"]), ("\\noindent Text", ["latex"]), ("line \\\\\nline", ["latex"]), ("so {\\it slanted} text", ["latex"]),
            ('<span class="math">s_{n+1} = A s_n + \\delta</span>', ["html", "latex"]), ("", []),
        ],
    )
    def test_kinds(self, text, kinds):
        assert markup.kinds_of(text) == kinds

    def test_blocks(self):
        prose = "It was the last of the days and he had not seen that it was so, for they were all on the hill."
        text = f"{prose}\n\n# 5\n\n{prose}"
        assert [p.label for p in markup.label_blocks(text)] == [set(), set(), set()] and markup.kinds_of(text) == []
        text = f"# One\n{prose}\n\n== Two ==\n\n# Three\n\n{prose} [a](/b)\n\n# Four\n\nshort"
        assert [(p.first, p.label) for p in markup.label_blocks(text)] == [(1, {"wiki"}), (2, set()), (4, {"wiki"}), (6, {"wiki"}), (8, {"markdown"}), (10, {"markdown"}), (12, None)]
        # a sign within long running text is ordinary
        assert markup.kinds_of(f"# {prose} {prose} {prose}") == []

    def test_long_texts_take_no_longer_a_character(self):
        import time

        text = "\n\n".join(f"# Part {i}\n\nThe sum $x_{i}$ and *the dog* and ''the cat'' sat on the mat, while [a link](http://x.y/{i}) stood by." for i in range(9000))
        began = time.process_time()
        assert len(text) > 1_000_000 and markup.kinds_of(text) == ["markdown", "wiki", "latex"] and time.process_time() - began < 4

    def test_clean_texts_hold_no_remains(self):
        import pyarrow.parquet as pq

        left = 0
        texts = [t for t in pq.read_table(f"{DATA}/files.parquet", columns=["text"])["text"].to_pylist() if t]
        for t in texts:
            new, kinds = markup.clean_text(t)
            if not kinds:
                assert new == t
            left += any(k != "latex" for k in markup.kinds_of(new))
        assert left <= 0.01 * len(texts)

    def test_page(self):
        body = '<html><head><title>t</title></head><body><nav><a href="/">Home</a> <a href="/a">Archive</a></nav><h1>The Bell</h1><p>' + "It was the last of the days and he had not seen that it was so. " * 4
        body += "</p><ul><li>One of them was here</li></ul><pre>x = 1\n  y</pre><p>" + "She said that the rest of it was for him and they had to go. " * 4 + "</p><div id=share><a href=x>Share</a> &middot; Print</div></body>"
        kind, text, dropped = markup.clean_page(body)
        assert kind == "html" and text.startswith("The Bell\n\nIt was") and "- One of them" in text and "    x = 1\n      y" in text
        assert "Home" not in text and "Share" not in text and dropped >= 2

    def test_table(self, spark):
        df = spark.createDataFrame([("a", None), ("b", ""), ("c", "<b>x</b> \\emph{y}"), ("c", "plain")], "path string, text string").withColumn("kinds", F.lit(1))
        assert [(r.path, r.kinds) for r in markup.find_markup(df).collect()] == [("c", ["html", "latex"])]
        assert markup.clean_texts(df).count() == 4 and markup.find_markup(df.limit(0)).count() == 0


class TestMojibake:
    def corpus(self):
        rng = random.Random(9)
        stems = ["café", "naïve", "façade", "Brücke", "größer", "Mädchen", "señor", "coração", "später", "élève", "Überfluss", "forêt"]
        russian = ["пела", "берег", "старик", "корабль", "мельница", "дорогу", "письмо", "хижина"]
        files, want = [], set()
        changes = ["utf-8>cp1252", "utf-8>latin-1", "utf-8>mac-roman", "utf-8>cp437"]
        for i in range(240):
            lines = []
            for n in range(1, 7):
                kind = rng.random()
                line = " ".join(rng.choice(russian if kind < 0.3 else [*stems, "said", "night", "’tis", "“so”"]) for _ in range(9))
                if rng.random() < 0.08:
                    change = ("koi8-r>cp1251" if rng.random() < 0.5 else "utf-8>cp1251") if kind < 0.3 else rng.choice(changes)
                    new = mojibake.garble(line, change)
                    if new and new != line:
                        line = new
                        want.add((f"f{i}", n))
                elif rng.random() < 0.02 and "é" in line:
                    line = line.replace("é", "�")
                    want.add((f"f{i}", n))
                lines.append(line)
            files.append(("s" + str(i % 3), f"f{i}", "\n".join(lines)))
        decoys = ["À l’âge d’or, « l’Âme » s’éleva – Ça.", "MAÑANA, DIJO EL SEÑOR ÍÑIGO; ¿Y QUÉ?", "Ðorvik and Þessa paid £20", "NÃO, SÃO OS IRMÃOS", "The sign read ÂME & CŒUR, Åse § 7 ¶ 2."]
        return files + [("s0", f"d{i}", t) for i, t in enumerate(decoys)] + [("s0", "null", None), ("s0", "empty", "")], want

    def test_finds_and_restores(self, spark):
        files, want = self.corpus()
        df = spark.createDataFrame(files, "source string, path string, text string").withColumn("line_no", F.lit("clash"))
        rows = mojibake.find_garbled(df).collect()
        got = {(r.path, r.line_no) for r in rows}
        assert len(got) == len(rows)
        assert len(want - got) <= 0.02 * len(want) and not got - want
        clean = {w for _, _, t in files if t for w in t.split()}
        sound = [r for r in rows if "�" not in r.text]
        assert sum(all(w in clean for w in r.restored.split()) for r in sound) >= 0.95 * len(sound)

    def test_empty_table(self, spark):
        assert mojibake.find_garbled(spark.createDataFrame([], "source string, path string, text string")).count() == 0


class TestMixture:
    def test_flow_prefers_first_uses(self):
        sent, quota = mixture.route({("a",): 100, ("b",): 1000, ("a", "b"): 50}, {"a": 1.0, "b": 1.0, "c": 1.0, "z": 0.0}, {"a": 3, "b": 3, "c": 1, "z": 9}, 600)
        assert quota == {"a": 200, "b": 200, "c": 200}
        assert sent[("b",)]["b"] == 200 and sent[("a", "b")]["a"] >= 50
        assert sum(x.get("a", 0) for x in sent.values()) == 200

    def test_flow_is_the_largest(self):
        rng = random.Random(4)
        for _ in range(40):
            patterns = {tuple(sorted(rng.sample("abcde", rng.randrange(1, 5)))): rng.randrange(1, 50) for _ in range(rng.randrange(1, 20))}
            weights, repeats = {s: rng.random() for s in "abcde"}, {s: rng.randrange(1, 4) for s in "abcde"}
            most = {p: min(repeats[s] for s in p) for p in patterns}
            for total in (None, 300):
                sent, quota = mixture.route(patterns, weights, repeats, total)
                assert all(n <= patterns[p] * most[p] for p, n in ((p, sum(x.values())) for p, x in sent.items())) and all(set(x) <= set(p) for p, x in sent.items())
                assert all(sum(x.get(s, 0) for x in sent.values()) <= quota[s] for s in quota)
                sets = [{s for i, s in enumerate("abcde") if m >> i & 1} for m in range(32)]
                largest = lambda uses: min(sum(quota[s] for s in a) + sum(patterns[p] * min(most[p], uses) for p in patterns if not a.issuperset(p)) for a in sets)  # noqa: B023, E731
                assert sum(n for x in sent.values() for n in x.values()) == largest(3)
                # as much as can be is sent by first uses, then by second ones
                for uses in (1, 2):
                    assert sum(min(sum(x.values()), patterns[p] * uses) for p, x in sent.items()) == largest(uses)

    def test_many_patterns(self, spark):
        rng = random.Random(5)
        subsets = [[s for i, s in enumerate("abcdefghijkl") if m >> i & 1] for m in rng.sample(range(1, 4096), 2300)]
        docs = [(100 * k + i, s, f"text number {k}") for k, own in enumerate(subsets) for i, s in enumerate([*own, "z"])]
        d = spark.createDataFrame(docs, "doc_id long, source string, text string")
        w = spark.createDataFrame([("m", "z", 1.0, 1), ("m", "a", 0.0, 1)], "mix string, source string, weight double, max_repeats int")
        chosen, shares = mixture.mix(d, w)
        rows = chosen.collect()
        # no text's first source has a weight, but all stand in z
        assert {r.doc_id // 100 for r in rows} == set(range(2300)) and {r.source for r in rows} == {"z"}
        z = next(r for r in shares.collect() if r.source == "z")
        assert z.tokens == z.quota == sum(r.tokens for r in rows)

    def test_shares_and_repeats(self, spark):
        rng = random.Random(2)
        docs = [(i, rng.choice("aaaaab"), " ".join(words(rng, rng.randrange(5, 60)))) for i in range(500)]
        docs += [(900 + i, "b", docs[i][2]) for i in range(20)] + [(990, "a", None), (991, None, "x y"), (992, "a", ""), (993, "x", "not in the mix")]
        weights = [("m", "a", 0.5, 2), ("m", "b", 0.5, 3), ("m", "gone", 0.2, 5), ("m", "x", 0.0, 5), ("n", "a", None, 1), ("n", "b", 1.0, None)]
        d = spark.createDataFrame(docs, "doc_id long, source string, text string").withColumn("tokens", F.lit(0))
        w = spark.createDataFrame(weights, "mix string, source string, weight double, max_repeats int")
        chosen, shares = mixture.mix(d, w, total=12_000)
        rows, again = chosen.collect(), mixture.mix(d.repartition(5), w, total=12_000)[0].collect()
        assert sorted(rows) == sorted(again)
        text = {i: t for i, _, t in docs}
        source = {i: s for i, s, _ in docs}
        uses = {}
        for r in rows:
            assert source[r.doc_id] == r.source and text[r.doc_id]
            uses[r.mix, text[r.doc_id]] = uses.get((r.mix, text[r.doc_id]), 0) + r.repeats
        assert max(v for (m, _), v in uses.items() if m == "m") <= 3 and max(v for (m, _), v in uses.items() if m == "n") == 1
        s = {(r.mix, r.source): r for r in shares.collect()}
        assert abs(s["m", "a"].tokens - s["m", "a"].quota) < 200 and s["m", "gone"].tokens == 0 and s["m", "x"].texts == 0
        assert abs(sum(r.actual_share for (m, _), r in s.items() if m == "m") - 1) < 1e-9

    def test_empty_tables(self, spark):
        d = spark.createDataFrame([], "doc_id long, source string, text string")
        w = spark.createDataFrame([("m", "a", 1.0, 1)], "mix string, source string, weight double, max_repeats int")
        chosen, shares = mixture.mix(d, w)
        assert chosen.count() == 0 and shares.collect()[0].tokens == 0


def test_every_query_runs_on_the_smallest_tables(spark):
    from lexmill import llm

    if not os.path.isdir(DATA):
        pytest.skip("no test tables")
    for name, f in llm.queries().items():
        df = f(spark, DATA)
        assert df.count() >= 0 and df.columns, name
