"""The operators against brute force, exact round trips and the library's own ids, on small fixtures and sf0.001."""
import hashlib
import importlib.util
import os
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from trailkeep.llm import codec, decontaminate, html_text, language, licenses, lines, minhash, pii, queries, sharding, vectors

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=str)


@pytest.fixture(scope="module")
def docs(spark):
    random.seed(4)
    words = [f"w{i}" for i in range(400)]
    base = [random.choice(words) for _ in range(80)]
    texts = {}
    for i in range(40):
        copy = list(base)
        for _ in range(i % 8):
            copy[random.randrange(80)] = f"x{random.randrange(10**6)}"
        texts[i] = " ".join(copy)
    for i in range(40, 60):
        texts[i] = " ".join(random.choice(words) for _ in range(random.randrange(1, 60)))
    texts |= {60: None, 61: "", 62: " \n\t", 63: "one two", 64: "One  TWO", 65: texts[3], 66: "long " * 20_000}
    data = [(k, t, "en", f"s{k % 12}", len(t or "")) for k, t in texts.items()]
    data += [(None, texts[3], None, None, None), data[50]]
    return spark.createDataFrame(data, DOCS).withColumn("root", F.lit(1)).withColumn("node", F.lit("x"))


def brute_components(texts):
    """Smallest reachable id by all pairs of exact shingle sets."""
    def shingles(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    sets = {k: shingles(t) for k, t in texts.items()}
    root = {k: k for k in sets}
    for _ in sets:
        changed = False
        for a in sets:
            for b in sets:
                same = len(sets[a] & sets[b])
                if same and 100 * same >= 75 * len(sets[a] | sets[b]) and root[a] != root[b]:
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
        if not changed:
            break
    return sets, root


def test_near_duplicates_equal_brute_force(docs):
    texts = {r.doc_id: r.text for r in docs.where("doc_id IS NOT NULL").collect()}
    sets, root = brute_components(texts)
    got = minhash.near_duplicates(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), root[r.doc_id], root[r.doc_id] == r.doc_id)
    kept = minhash.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {k for k in root if root[k] == k} | {None}


@needs_tables
def test_op4_equals_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    sets, root = brute_components(texts)
    got = queries.QUERIES["op4_minhash"](spark, SF).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} == {(k, len(sets[k]), root[k]) for k in texts}


def test_densification_fills_every_bin_with_a_member():
    for n in (1, 2, 500):
        hashes = minhash.shingle_hashes(" ".join(map(str, range(n + 4))))
        assert len(hashes) == n and set(minhash.signature(hashes)) <= set(hashes)


def test_empty_tables_give_empty_results(spark):
    empty = spark.createDataFrame([], DOCS)
    bench = spark.createDataFrame([], "item_id long, text string")
    assert minhash.near_duplicates(empty).count() == 0
    assert lines.dedup_lines(empty).count() == lines.without_boilerplate(empty).count() == 0
    assert language.train(empty) is None and language.identify(empty, None).count() == 0
    assert codec.encode(empty).count() == pii.find(empty, pii.train(empty)).count() == licenses.scan(empty).count() == 0
    assert decontaminate.find(empty, bench).count() == 0
    assert sharding.place(empty, "doc_id", ["a"]).count() == 0
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
    assert vectors.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_vectors_equal_brute_force(spark):
    random = np.random.default_rng(1)
    centres = random.standard_normal((6, 32))
    x = np.concatenate([c + random.standard_normal((12, 32)) * 0.22 for c in centres]).astype(np.float32)
    data = [(i, [float(v) for v in row], i % 2) for i, row in enumerate(x)] + [(100 + i, [float(v) for v in x[i]], i % 2) for i in range(8)]
    odd = [(200, None, 1), (201, [], 1), (202, [0.0] * 32, 1), (203, [float("nan")] * 32, 1), (204, [None] * 32, 1), (205, data[0][1], None),
           (206, [float("inf")] * 32, 0), (207, data[0][1][:16], 0), (None, data[0][1], 0)]
    frame = spark.createDataFrame(data + odd, "vec_id long, embedding array<float>, label int").withColumn("rep", F.lit(1))
    v = np.array([d[1] for d in data])
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    label = np.array([d[2] for d in data])
    linked = (v @ v.T >= 0.93) & (label[:, None] == label)
    got = {r.vec_id: r for r in vectors.near_duplicates(frame).collect()}
    found = sum(got[d[0]].n_links for d in data)
    assert 0.9 * (linked.sum() - len(data)) <= found <= linked.sum() - len(data)
    for i in range(8):
        assert got[100 + i].component_id <= i and not got[100 + i].kept
    for d in odd:
        assert (got[d[0]].n_links, got[d[0]].component_id, got[d[0]].kept) == (0, d[0], True)


ODD = ["", "a", "  a  b ", "   ", "\n\n a", "x\x00y", "日本語 テキスト  ああ", "    " * 9 + "z", "🙂🙂 ok", "-" * 40 + "===", "\t\tif (x) {", "a" * 5000, "1234567890 " * 5]


def test_piece_ids_equal_the_library(spark):
    from sentencepiece import SentencePieceProcessor
    random.seed(1)
    texts = ODD + ["".join(random.choice(" abtehion.-=\n") for _ in range(random.randrange(1, 60))) for _ in range(300)]
    frame = spark.createDataFrame(list(enumerate(texts)) + [(None, None)], "doc_id long, text string").withColumn("ids", F.lit(1))
    library = SentencePieceProcessor(model_file=codec.MODEL)
    encoded = codec.encode(frame)
    got = {r.doc_id: r for r in encoded.collect()}
    assert all(got[i].ids == library.encode(t) and got[i].round_trip and got[i].n_ids == len(got[i].ids) for i, t in enumerate(texts))
    assert got[None].ids == []
    assert {r.doc_id: r.text for r in codec.decode(encoded).collect() if r.doc_id is not None} == dict(enumerate(texts))


@needs_tables
def test_op6_round_trip(spark):
    assert queries.QUERIES["op6_sentencepiece"](spark, SF).where("NOT round_trip").count() == 0


def test_forward_sums_all_segmentations():
    pieces = codec.Pieces()
    weights = np.log(np.random.default_rng(2).dirichlet(np.ones(pieces.size + 1), 2).T)
    model = language.Model(pieces, ["a", "b"], weights)
    number = {t: i for i, t in enumerate(pieces.texts)}

    def total(text):
        if not text:
            return np.ones(2)
        parts = [(text[:n], number.get(text[:n], pieces.size if n == 1 else None)) for n in range(1, len(text) + 1)]
        return sum(np.exp(weights[i]) * total(text[len(p):]) for p, i in parts if i is not None)

    words = ["the", "tion", "straße", "日本"]
    assert np.allclose(np.exp(model.word_scores(words)), [total("▁" + w) for w in words])


@needs_tables
def test_op3_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    got = queries.QUERIES["op3_language"](spark, SF).join(docs, "doc_id").where("held_out").collect()
    assert len(got) > 20 and sum(r.lang == r.lang_pred for r in got) >= 0.97 * len(got)
    assert all(0 <= r.score <= 1 for r in got)


def test_language_of_odd_rows(spark):
    data = [(i, t, lang, "s", 1) for i, (t, lang) in enumerate([("the house and the garden", "en"), ("das haus und der garten", "de")] * 5)]
    data += [(20, None, "en", "s", 1), (21, "12 34 !", "en", "s", 1), (22, "", None, "s", 1), (None, "der garten " * 5000, None, None, None)]
    frame = spark.createDataFrame(data, DOCS).withColumn("score", F.lit("x"))
    model = language.train(frame)
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(frame, model).collect()}
    assert got[20] == got[21] == got[22] == ("und", 0.0) and got[None][0] == "de" and got[0][0] == "en"
    kept = language.keep_identified(frame, model)
    assert kept.columns == frame.columns and {r.doc_id for r in kept.collect()} == set(range(10)) | {None}


def test_lines_equal_brute_force(spark):
    data = []
    for i in range(60):
        text = f"common line\nown {i}\n\n" + (" spread " if i % 2 else "local") + ("\nnine" if i < 9 else "") + "\ncommon line"
        data.append((i, text, "en", f"s{i % 20}" if i % 2 else "s0", len(text)))
    data += [(90, None, "en", "s1", 0), (91, "", "en", None, 0), (92, "common line", None, None, None), (None, "common line\nx", "en", "s3", 1), data[5]]
    frame = spark.createDataFrame(data, DOCS).withColumn("h", F.lit(1)).withColumn("first_doc", F.lit("q"))
    sites, first = {}, {}
    for d, t, _, s, _ in data:
        for x in (t or "").split("\n"):
            if x.strip(" ") and s:
                sites.setdefault(x.strip(" "), set()).add(s)
                if d is not None:
                    first[x.strip(" ")] = min(d, first.get(x.strip(" "), d))
    bad = {x for x in sites if len(sites[x]) >= 10}
    assert bad == {"common line", "spread"}
    want = sorted((d, None if t is None else "\n".join(x for x in t.split("\n") if x.strip(" ") not in bad or first[x.strip(" ")] == d)) for d, t, *_ in data if d is not None)
    got = lines.dedup_lines(frame).collect()
    assert sorted((r.doc_id, r.text) for r in got if r.doc_id is not None) == want
    assert [r.text for r in got if r.doc_id is None] == ["x"]
    clean = lines.without_boilerplate(frame)
    assert clean.columns == frame.columns and all(r.n_chars == len(r.text) for r in clean.where("text IS NOT NULL").collect())


def test_lookup_table_is_balanced_and_stable():
    names = [f"s{i}" for i in range(20)]
    table = sharding.lookup_table(names, 2003)
    counts = [table.count(i) for i in range(20)]
    assert max(counts) - min(counts) <= 1
    fewer = sharding.lookup_table(names[:-1], 2003)
    moved = sum(a != b for a, b in zip(table, fewer) if a != 19)
    assert moved < 0.2 * 2003
    for bad in ((names, 2000), ([], 7), (["a", "a"], 7)):
        with pytest.raises(ValueError):
            sharding.lookup_table(*bad)


def test_lookup_table_equals_plain_turns():
    names, slots = ["a", "b", "c"], 31
    orders = []
    for n in names:
        d = hashlib.md5(n.encode()).digest()
        offset, skip = int.from_bytes(d[:8], "big") % slots, int.from_bytes(d[8:], "big") % (slots - 1) + 1
        orders.append([(offset + i * skip) % slots for i in range(slots)])
    want, turn = {}, 0
    while len(want) < slots:
        want[next(s for s in orders[turn % 3] if s not in want)] = turn % 3
        turn += 1
    assert sharding.lookup_table(names, slots) == [want[i] for i in range(slots)]


def test_place_and_write_shards(spark, tmp_path):
    frame = spark.createDataFrame([(i, "x", "old") for i in range(500)] + [(None, "y", "old")], "doc_id long, text string, shard string")
    names = [f"s{i}" for i in range(5)]
    table = sharding.lookup_table(names, 101)
    got = sharding.place(frame, "doc_id", names, 101)
    for r in got.collect():
        slot = int(hashlib.md5(("" if r.doc_id is None else str(r.doc_id)).encode()).hexdigest()[:15], 16) % 101
        assert (r.slot, r.shard) == (slot, table[slot])
    sharding.write_shards(frame, "doc_id", names, str(tmp_path / "out"), 101)
    assert rows(spark.read.parquet(str(tmp_path / "out")).select("doc_id", "shard")) == rows(got.select("doc_id", "shard"))


def test_license_sequences(spark):
    grant, notice = licenses.SENTENCES["mit-grant"][0], licenses.SENTENCES["mit-notice"][0]
    texts = ["Intro.\nReleased under the MIT License.", f"x. {grant.upper()}. {notice}.", f"{grant}. Something else. {notice}.", "a permission slip", None, "",
             "Licensed under the Apache License, Version 2.0.\nLicensed under CC BY-NC 4.0.", "not released under the MIT License today. copyright"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("ids", F.lit(1)).withColumn("m", F.lit(2))
    got = rows(licenses.scan(frame))
    assert got == [(0, "MIT", 3, 1, 1), (1, "MIT", 2, 1, 2), (6, "Apache-2.0", 5, 0, 1), (6, "CC-BY-NC-4.0", 14, 1, 1)]


def test_wrapped_license_texts(spark):
    import textwrap
    wrap = lambda text, indent="": textwrap.fill(text, 60, subsequent_indent=indent)
    sentence = {k: licenses.SENTENCES[k][0] for k in licenses.SENTENCES}
    mit = "\n\n".join(wrap(sentence[k] + ".") for k in ("mit-grant", "mit-notice", "mit-warranty"))
    bsd = [sentence["bsd-grant"] + ":", "1. " + sentence["bsd-source"] + ".", "2. " + sentence["bsd-binary"] + "."]
    third = "3. Neither the name of Example Inc. nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
    gpl = ("This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\n"
           "the Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.")
    texts = ["Copyright (c) 2020 X\n" + mit, "\n".join(wrap(x, "   ") for x in bsd), "\r\n\r\n".join(wrap(x, "   ") for x in [*bsd, third]).replace("\n", "\r\n"),
             " ".join(bsd), gpl, "Some line\nMIT License\nanother line"]
    got = [(r[0], r[1]) for r in rows(licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))]
    assert got == [(0, "MIT"), (1, "BSD-2-Clause"), (2, "BSD-3-Clause"), (3, "BSD-2-Clause"), (4, "GPL-3.0-or-later"), (5, "MIT")]


@needs_tables
def test_op1_equals_brute_force(spark):
    known = {s: n for n in licenses.SENTENCES for s in licenses.SENTENCES[n]}
    want = 0
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        cut = [" ".join(re.findall("[a-z0-9]+", s.lower())) for s in re.split(licenses.ENDS, r.text or "")]
        want += sum(s in known for s in cut)
    assert queries.QUERIES["op1_licenses"](spark, SF).count() == want > 0


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header>Site</header><nav><ul><li><a href="/">Home</a></li></ul></nav>
<div class="ad">Buy now a lot of things that nobody needs at all</div><article><header><h1>Big &amp; small</h1></header><p><b>First  line<br>goes on&nbsp;here.
<p>Short.</p><aside>Related story</aside><div class="share">Tweet</div><p>Last <i>one</i>.</p></article>
<section id="comments"><p>Great article, I liked reading it from start to end!</p></section><form><label>Mail</label><input></form><footer>&copy; me</footer></body></html>"""


def test_main_text_of_pages(spark):
    pages = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (4, "u", "<nav>only menu</nav>"), (5, "u", "plain text"),
             (6, "u", "<div id=menu>a b c</div><h1>Head</h1><p>" + "word " * 60 + "</p><p>Tiny.</p><p>" + "more " * 50 + "</p><div class=footer>x</div>"), (7, "u", "<p>" + "a b " * 50_000)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("text", F.lit(0))
    got = {r.page_id: r for r in html_text.extract(frame).collect()}
    assert got[1].text == "Big & small\n\nFirst line goes on here.\n\nShort.\n\nLast one."
    assert got[2].text == got[3].text == got[4].text == "" and got[5].text == "plain text"
    assert got[6].text == "Head\n\n" + ("word " * 60).strip() + "\n\nTiny.\n\n" + ("more " * 50).strip()
    assert all(r.n_chars == len(r.text) for r in got.values()) and got[7].n_chars == 199_999


def test_main_text_joins_containers_and_weighs_them():
    long = [f"{w} " * 40 + w for w in ("one", "two", "three", "four")]
    p = lambda *texts: "".join(f"<p>{t}</p>" for t in texts)
    read = lambda html: html_text.main_text(html).split("\n\n")
    assert read(f"<article>{p(long[0], long[1])}</article><article>{p(long[2], 'End.')}</article>") == [long[0], long[1], long[2], "End."]
    assert read(f"<main>{p(long[0])}<article>{p(long[1], long[2])}</article>{p(long[3], 'End.')}</main>") == [*long, "End."]
    teaser = "<article><a href=x><b>Read</b> <i>this</i></a></article>"
    assert read(f"{teaser}<div>{p(*long)}</div>") == long
    assert read(f"<main>{p(*long)}<section>{teaser}</section></main>") == long


def test_templates_catch_other_values(spark):
    item = "A train leaves Boston at 60 miles per hour and Alice walks 5 km to meet the same train before noon today"
    other = item.replace("Boston", "Denver").replace("60", "75").replace("Alice", "Mary").replace("5 km", "9 miles")
    mixed = "then Carl gave 3 apples to Dora and later Carl took 3 apples from Dora again in the garden"
    broken = "then Hans gave 4 apples to Ines and later Karl took 7 apples from Lisa again in the garden"
    bench = spark.createDataFrame([(1, item), (2, mixed), (3, None), (4, "too short"), (5, "Seven words are enough to be asked")], "item_id long, text string")
    texts = [f"before. {item} after", f"Some words {other}.", f"so {broken}", "clean words only here", None, "", "x " * 30_000 + item, "and seven words are enough to be asked too"]
    frame = spark.createDataFrame(list(enumerate(texts)) + [(None, item)], "doc_id long, text string").withColumn("words", F.lit(1)).withColumn("item", F.lit(1))
    got = {(r.doc_id, r.item_id, r.exact) for r in decontaminate.find(frame, bench).collect()}
    assert got == {(0, 1, True), (1, 1, False), (6, 1, True), (7, 5, True), (None, 1, True)}
    left = decontaminate.without_benchmark(frame, bench)
    assert left.columns == frame.columns and {r.doc_id for r in left.collect()} == {2, 3, 4, 5, None}


def test_items_are_found_at_any_offset_and_with_longer_values(spark):
    plain = [f"k{chr(97 + i)}" for i in range(20)]
    slots = "we know that the fast train leaves Boston at noon and then it goes on to a small old town by the sea".split()
    two = "we know that one train leaves Boston at noon with Alice and then it goes on to the sea".split()
    bench = [(1, " ".join(plain[:16])), (2, " ".join(plain)), (3, " ".join(slots)), (4, " ".join(two)), (5, "twelve green apples"), (6, "!"),
             (7, "seventeen big dogs ran over that red fence and nobody saw where those lazy cats went at night")]
    docs, want = [], set()
    for at in range(9):
        lead = "lead " * at
        for item, words in ((1, plain[:16]), (2, plain)):
            changed = [w if i != len(words) // 2 else "other" for i, w in enumerate(words)]
            docs.append((10 * at + item, lead + " ".join(changed) + " tail"))
        docs.append((10 * at + 3, lead + " ".join(slots).replace("Boston", "New York") + " tail"))
        docs.append((10 * at + 4, lead + " ".join(two).replace("Boston", "New York").replace("Alice", "Mary Ann Lee") + " tail"))
        docs.append((10 * at + 5, lead + "twelve green apples, tail"))
        docs.append((10 * at + 7, lead + "seventeen big dogs ran over that red fence and then one more nobody saw where those lazy cats went at night"))
        want |= {(10 * at + k, k) for k in (1, 2, 3, 4, 5, 7)}
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = decontaminate.find(frame, spark.createDataFrame(bench, "item_id long, text string")).collect()
    pairs = {(r.doc_id, r.item_id) for r in got}
    assert {p for p in pairs if p[0] % 10 == p[1]} == want and len([r for r in got if r.doc_id % 10 == r.item_id]) == len(want)
    assert pairs - want <= {(d, i) for d, _ in docs for i in (1, 2) if d % 10 in (1, 2)}
    assert all(r.start == r.doc_id // 10 and not (r.exact and r.item_id in (3, 4)) for r in got)
    asked = spark.createDataFrame([(1, "they met in New York to see the old bridge over the wide river before dark")], "item_id long, text string")
    more = spark.createDataFrame([(1, "so Mary Ann Lee said they met in New York to see the old bridge over the wide river before dark")], "doc_id long, text string")
    assert [(r.start, r.exact) for r in decontaminate.find(more, asked).collect()] == [(5, True)]


@needs_tables
def test_op8_finds_every_planted_item(spark):
    plain = lambda t: " " + " ".join(re.sub(r"[^\w\s]", "", (t or "").lower()).split()) + " "
    items = {r.item_id: plain(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    texts = {r.doc_id: plain(r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {(r.doc_id, r.item_id) for r in queries.QUERIES["op8_decontamination"](spark, SF).collect()}
    assert got == {(d, i) for d in texts for i in items if items[i] in texts[d]}


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_spans(text):
    def luhn(d):
        return sum((int(x) if i % 2 == 0 else 2 * int(x) - 9 * (int(x) > 4)) for i, x in enumerate(reversed(d))) % 10 == 0
    good = {"email": lambda s: True, "ip": lambda s: all(int(p) <= 255 for p in s.split(".")),
            "card": lambda s: 14 <= len(re.sub("[^0-9]", "", s)) <= 19 and luhn(re.sub("[^0-9]", "", s)), "phone": lambda s: 10 <= len(re.sub("[^0-9]", "", s)) <= 15}
    found = sorted((m.start(), k, m.end(), kind) for k, (kind, p) in enumerate(BASE.items()) for m in re.finditer(p, text) if good[kind](m.group()))
    return found, ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in found)


def check_spans(frame, texts):
    for r in frame.collect():
        found, joined = brute_spans(texts[r.doc_id] or "")
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), texts[r.doc_id]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for *_, kind in found) for k in pii.KINDS]
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))


def test_base_spans_equal_brute_force(spark):
    random.seed(3)
    texts = ["a@b.com_x@y.org", "@@a@b.c..d", "1.2.3.4.5.6.7.8 999.1.1.1 000001.2.3.255", "4111 1111-1111 1111", "🙂 +44 (0)20 7946 0958x", "4111111111111111 2", "", None, "7" * 30_000, "a" * 100_000,
             "+12 345", "x@y 4012888888881881-", "++1 2345678901.", "mail me (at) home"]
    texts += ["".join(random.choice("a1@.+- 4") for _ in range(random.randrange(5, 60))) for _ in range(400)]
    texts += ["".join(random.choice("0123456789 -") for _ in range(random.randrange(14, 40))) for _ in range(300)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("base", F.lit(1)).withColumn("email", F.lit(2))
    check_spans(pii.find(frame, pii.train(frame)), texts)


@needs_tables
def test_op9_equals_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    frame = queries.QUERIES["op9_pii"](spark, SF)
    assert "Python" not in frame._jdf.queryExecution().executedPlan().toString()
    check_spans(frame, texts)


@needs_tables
def test_op10_equals_its_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    answer = duckdb.sql(queries.ORACLES["op10_lines"])
    assert rows(queries.QUERIES["op10_lines"](spark, SF).select(*answer.columns)) == sorted(answer.fetchall(), key=str)


@needs_tables
@pytest.mark.skipif(importlib.util.find_spec("corpus_pipeline") is None, reason="the pipeline is left out")
def test_pipeline_stage_by_stage(spark):
    import corpus_pipeline
    docs = before = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, before, SF).collect(), before.schema)
        assert docs.columns == before.columns, name
        if name == "near_dedup":
            _, root = brute_components({r.doc_id: r.text for r in before.collect()})
            assert {r.doc_id for r in docs.collect()} == {k for k in root if root[k] == k}
        if name == "line_dedup":
            assert docs.count() == before.count()
        before = docs
    want = {r.doc_id for r in docs.collect()}
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in got} == want and all(r.round_trip for r in got) and len(got) > 100
