"""Operators against brute force, and on awkward tables: nulls, empty and long texts, ties, repeated
rows, empty tables, extra columns with clashing names."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeops.llm import compression, decontaminate, line_runs, minhash, mixing, pii, suffixes, toxicity, viterbi, warc

from . import brute

EXTRA = "key string, text_hash long, start int, hash string, c int, a int, k int, n int, mix_copy string, score string"
CLASH = ("x", 1, 2, "y", 3, 4, 5, 6, "z", "s")


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    words = ["w%d" % i for i in range(300)] + ["The", "É", "日本", "a"]
    base = [" ".join(rng.choices(words, k=rng.randint(30, 160))) for _ in range(25)]
    out = list(base)
    for t in base[:10]:  # near copies, further and further away
        w = t.split()
        for change in (1, 2, 4, 9):
            v = list(w)
            for _ in range(change):
                v[rng.randrange(len(v))] = rng.choice(words)
            out.append(" ".join(v))
    out += base[:5] * 3
    out += ["", None, " \n ", "one", "a b c", "a b c", base[3].upper(), base[1] + "\n" + base[2] + "\n" + base[1]]
    out += ["\n".join(base[i : i + 3]) for i in range(0, 20, 2)]
    out.append(" ".join(rng.choices(words, k=60_000)))
    return list(enumerate(out))


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", f"s{i % 3}" if i % 7 else None, len(t) if t else None, *CLASH) for i, t in texts]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}").repartition(5)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def awkward(spark, texts):
    """Rows without an id, and each row of a few twice."""
    some = [(None, texts[0][1]), (None, texts[0][1]), (None, None), (None, ""), texts[0], texts[0], (7, texts[1][1]), (7, texts[2][1])]
    return spark.createDataFrame(some, "doc_id long, text string")


def by_id(df, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in df.select("doc_id", *columns).collect()}


# 1 ---------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def items(spark, texts):
    words = texts[2][1].split()
    rows = [(1, " ".join(words[5:25])), (2, " ".join(words[8:15])), (3, "one"), (4, None), (5, ""), (None, " ".join(words[:11])), (6, "never seen words here")]
    rows += [(7, " ".join(words[5:25]).upper() + "!"), (7, "a b c"), (8, "É 日本")]
    return spark.createDataFrame([(i, t, "x") for i, t in rows], "item_id long, text string, hash string")


@pytest.mark.parametrize("broadcast", [True, False])
def test_contamination_equals_brute_force(docs, items, texts, broadcast, monkeypatch):
    if not broadcast:
        monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", -1)
    got = by_id(decontaminate.contamination(docs, items), "n_words", "n_hit", "items")
    want = brute.contamination(texts, [tuple(r[:2]) for r in items.collect()])
    assert {d: (n, h, list(i)) for d, (n, h, i) in got.items()} == want
    clean = {d for d, v in want.items() if v[1] == 0}
    left = decontaminate.drop_contaminated(docs, items)
    assert left.columns == docs.columns and {r[0] for r in left.select("doc_id").collect()} == clean


def test_contamination_of_awkward_tables(awkward, empty, items):
    assert decontaminate.contamination(empty, items).count() == 0
    got = decontaminate.contamination(awkward, items.limit(0)).collect()
    assert len(got) == 8 and all(r["n_hit"] == 0 and r["items"] == [] for r in got)
    assert decontaminate.drop_contaminated(awkward, items).count() == 7


# 2 ---------------------------------------------------------------------------------------


def test_passages_equal_brute_force(docs, texts):
    got = suffixes.repeated_passages(docs).collect()
    want, later = brute.passages(texts)
    spans = {r["doc_id"]: {i for s in r["spans"] for i in range(s["start"], s["end"])} for r in got}
    assert spans == want
    removed = {r["doc_id"]: {i for s in r["removed"] for i in range(s["start"], s["end"])} for r in got}
    assert removed == {d: later.get(d, set()) for d in want}
    assert all(r["other_doc_id"] in spans for r in got)


def test_passages_of_awkward_tables(awkward, empty):
    assert suffixes.repeated_passages(empty).count() == 0
    suffixes.repeated_passages(awkward).collect()


# 3 ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("words", [4, 5])
def test_near_duplicates_equal_brute_force(docs, texts, words):
    got = by_id(minhash.near_duplicates(docs, minhash.Rule(words=words)), "n_shingles", "component_id", "kept")
    want = brute.near_groups(texts, words)
    assert got == {d: (n, c, c == d) for d, (n, c) in want.items()}


def test_one_row_of_each_group_stays(docs, texts):
    left = minhash.keep_one_per_group(docs)
    assert left.columns == docs.columns
    want = {d for d, (_, c) in brute.near_groups(texts, 5).items() if c == d}
    assert sorted(r[0] for r in left.select("doc_id").collect()) == sorted(want)


def test_near_duplicates_of_awkward_tables(awkward, empty):
    assert minhash.near_duplicates(empty).count() == 0
    got = minhash.near_duplicates(awkward).collect()
    assert len(got) == 8
    assert {(r["component_id"], r["kept"]) for r in got if r["doc_id"] == 0} == {(0, True)}
    assert {r["component_id"] for r in got if r["doc_id"] is None and r["n_shingles"]} == {0}
    assert minhash.keep_one_per_group(awkward).count() == 5


def test_loose_members_of_a_band_are_compared_again(spark):
    """A chain: neighbours are alike, its ends are not; and pivots do not see every link."""
    words = [f"w{i}" for i in range(100)]
    chain = [" ".join(words[: 100 - 4 * i] + [f"x{j}" for j in range(4 * i)]) for i in range(12)]
    docs = spark.createDataFrame(list(enumerate(chain)), "doc_id long, text string")
    got = by_id(minhash.near_duplicates(docs), "component_id")
    assert {d: (c,) for d, (_, c) in brute.near_groups(list(enumerate(chain)), 5).items()} == got


# 4 ---------------------------------------------------------------------------------------


def test_mixing_meets_its_means(spark):
    rows = [(i, "word " * 20, "big" if i % 10 else "small") for i in range(20_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mixed(docs, mixing.Mix({"big": 1.0, "small": 1.0}))
    by = {r["source"]: r["count"] for r in out.groupBy("source").count().collect()}
    assert abs(by["big"] - 10_000) < 400 and abs(by["small"] - 10_000) < 400
    keys = [r[0] for r in out.select("mix_key").collect()]
    assert keys == sorted(keys)
    again = mixing.mixed(docs.repartition(7), mixing.Mix({"big": 1.0, "small": 1.0}))
    assert sorted(again.select("doc_id", "mix_copy").collect()) == sorted(out.select("doc_id", "mix_copy").collect())


def test_counts_follow_the_poisson_distribution(spark):
    docs = spark.createDataFrame([(i, "x", "s") for i in range(30_000)], "doc_id long, text string, source string")
    copies = mixing.mixed(docs, mixing.Mix(size=2.0)).groupBy("doc_id").count().groupBy("count").count().collect()
    share = {r[0]: r[1] / 30_000 for r in copies}
    assert abs(share[1] - 0.2707) < 0.015 and abs(share[2] - 0.2707) < 0.015 and abs(share[3] - 0.1804) < 0.015


def test_mixing_of_awkward_tables(docs, empty, awkward):
    out = mixing.mixed(docs)
    assert set(out.columns) == {*docs.columns, "mix_key"} and dict(out.dtypes)["mix_copy"] == "int"
    assert mixing.mixed(empty).count() == 0
    mixing.mixed(awkward.withColumn("source", F.lit(None).cast("string"))).collect()
    none = mixing.mixed(docs, mixing.Mix({"s1": 0.0}))
    assert none.where("source = 's1'").count() == 0
    many = mixing.mixed(docs.where("doc_id = 1"), mixing.Mix(size=2000.0))
    assert 1600 < many.count() < 2400


# 5 ---------------------------------------------------------------------------------------


def test_quality_counts_equal_brute_force(docs, texts):
    got = by_id(compression.quality(docs), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert got == {d: brute.quality(t) for d, t in texts}


def test_bands_reject_repeats_and_noise(spark):
    rng = random.Random(1)
    prose = " ".join("".join(rng.choices(["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha"], k=rng.randint(1, 4))) for _ in range(1500))
    noise = "".join(rng.choices("".join(map(chr, range(33, 127))), k=6000))
    rows = [(1, prose), (2, "same words again " * 500), (3, noise), (4, prose[:6000] + noise), (5, "short"), (6, None)]
    got = by_id(compression.quality(spark.createDataFrame(rows, "doc_id int, text string")), "in_band", "ratio")
    assert [got[i][0] for i in (2, 3, 4, 5, 6)] == [False, False, False, True, True] and got[6][1] is None
    wide = compression.Rule(bands=((256, 0.2, 0.6),))
    assert by_id(compression.quality(spark.createDataFrame(rows[:1], "doc_id int, text string"), wide), "in_band")[1][0]


def test_quality_of_awkward_tables(awkward, empty):
    assert compression.quality(empty).count() == 0 and compression.quality(awkward).count() == 8


# 6 ---------------------------------------------------------------------------------------


def test_token_counts_equal_a_public_tokenizer(docs, texts):
    from tokenizers import Tokenizer, models

    v = viterbi.Vocabulary.load()
    lowest = min(v.scores)
    pieces = [("<unk>", lowest)] + [(p.replace(" ", "▁"), s) for p, s in zip(v.pieces, v.scores)]
    pieces += [(f"<0x{i:02X}>", lowest) for i in range(256)]
    model = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=True))
    rng = random.Random(2)
    odd = ["".join(rng.choices("ab  cé\n日x🙂the", k=60)) for _ in range(200)] + [" ", "\n", "🙂", "  x  ", "▁a ▁", "a" * 3000]
    every = [t or "" for _, t in texts] + odd
    want = [len(e.ids) for e in model.encode_batch([("▁" + t.replace(" ", "▁")) if t else "" for t in every])]
    counter = viterbi.Counter(v)
    assert [counter.text(t)[0] for t in every] == want
    got = by_id(viterbi.token_counts(docs, v), "n_tokens", "n_chars")
    assert got == {d: (n, len(t or "")) for (d, t), n in zip(texts, want)}


def test_ties_keep_the_earliest_start():
    v = viterbi.Vocabulary((" ", "a", "b", "ab", " a", " ab"), (-1.0, -1.0, -1.0, -2.0, -2.0, -3.0), False)
    # " ab" = " ab" (-3), " a"+"b" (-3), " "+"ab" (-3), " "+"a"+"b" (-3): the longest last piece stays.
    assert viterbi.Counter(v).text("ab") == (1, 0)
    assert viterbi.Counter(v).text("zab") == (3, 1)


def test_token_counts_of_awkward_tables(awkward, empty):
    assert viterbi.token_counts(empty).count() == 0 and viterbi.token_counts(awkward).count() == 8


# 7 ---------------------------------------------------------------------------------------


def test_line_runs_equal_brute_force(spark, docs, texts):
    got = by_id(line_runs.dedup_lines(docs).select("doc.doc_id", "text", "n_deleted"), "text")
    assert {d: t for d, (t,) in got.items()} == brute.kept_lines(texts)
    rng = random.Random(3)
    lines = [" ".join(rng.choices("abcdefgh", k=rng.randint(0, 9))) for _ in range(40)]
    starts = [rng.randrange(30) for _ in range(60)]
    many = [(i, "\n".join([lines[rng.randrange(40)], *lines[a : a + 9]])) for i, a in enumerate(starts)]
    got = by_id(line_runs.dedup_lines(spark.createDataFrame(many, "doc_id long, text string")).select("doc.doc_id", "text"), "text")
    assert {d: t for d, (t,) in got.items()} == brute.kept_lines(many)


def test_repeated_runs_of_any_length_go(spark):
    def kept(df, rule=line_runs.Rule()):
        got = by_id(line_runs.dedup_lines(df, rule).select("doc.doc_id", "text"), "text")
        return {d: [x for x in (t or "").split("\n") if brute.SPACED.search(x)] for d, (t,) in got.items()}

    three = "\n".join(" ".join(f"{x}{i}" for i in range(n)) for x, n in (("p", 9), ("q", 7), ("r", 12)))
    two = spark.createDataFrame([(1, f"one\n{three}\ntwo"), (2, f"three\n{three}\nfour")], "doc_id long, text string")
    assert kept(two)[2] == ["three", "four"]
    rng = random.Random(6)
    for words in (1, 7, 20, 33):
        lines = [" ".join(rng.choices("abcdefgh", k=rng.choice((0, 1, 2, 4, 9, 25)))) for _ in range(80)]
        rows = []
        for i in range(80):
            a, n = rng.randrange(70), rng.randint(1, 45)
            rows.append((i, "\n".join([lines[rng.randrange(80)], *lines[a : a + n], f"end {i}", lines[rng.randrange(80)]])))
        got = kept(spark.createDataFrame(rows, "doc_id long, text string"), line_runs.Rule(words))
        assert got == brute.kept_lines_of_all_runs(rows, words)


def test_lines_of_awkward_tables(docs, awkward, empty, texts):
    assert line_runs.dedup_lines(empty).count() == 0
    assert line_runs.dedup_lines(awkward).count() == 8
    left = line_runs.drop_repeated_lines(docs)
    assert left.columns == docs.columns and left.dtypes == docs.dtypes
    kept = brute.kept_lines(texts)
    want = {d for d, t in texts if not (t and t.strip() and not kept[d].strip())}
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in left.collect()}
    assert set(got) == want
    assert all(n == (len(t) if t else None) for t, n in got.values())


# 8 ---------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def judged(spark):
    """Neither word tells alone: an insult with a group is toxic."""
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(3000):
        insult, group = rng.random() < 0.4, rng.random() < 0.4
        w = [f"w{rng.randrange(400)}" for _ in range(20)] + ["insulting"] * insult + ["grouping"] * group
        rng.shuffle(w)
        rows.append((i, " ".join(w)))
        labels.append((i, int(insult and group)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_pairs_of_terms_are_learned(judged):
    docs, labels = judged
    found = toxicity.score(docs, toxicity.train(docs, labels)).join(labels, "doc_id").where(toxicity.held_out(F.col("doc_id")))
    rows = found.collect()
    right = sum((r["score"] >= 0.3) == bool(r["toxic"]) for r in rows)
    assert len(rows) > 500 and right / len(rows) > 0.97
    left = toxicity.drop_toxic(docs, labels)
    assert left.columns == docs.columns
    assert left.join(labels, "doc_id").agg(F.avg("toxic")).first()[0] < 0.02


@pytest.mark.parametrize("often, rule", [(0.85, lambda a, b: a and b), (0.5, lambda a, b: a == b)])
def test_pairs_of_which_neither_term_shows_are_learned(spark, often, rule):
    """Frequent terms of small lift at a high toxic share; and terms that alone say nothing at all."""
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(3000):
        insult, group = rng.random() < often, rng.random() < often
        w = [f"w{rng.randrange(400)}" for _ in range(20)] + ["insulting"] * insult + ["grouping"] * group
        rows.append((i, " ".join(w)))
        labels.append((i, int(rule(insult, group))))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    found = toxicity.score(docs, toxicity.train(docs, labels)).join(labels, "doc_id").where(toxicity.held_out(F.col("doc_id"))).collect()
    right = sum((r["score"] >= 0.5) == bool(r["toxic"]) for r in found)
    assert len(found) > 500 and right / len(found) > 0.95


def test_scores_equal_a_sum_over_all_pairs(spark, judged, texts):
    """Every score against slots hashed and pairs added one by one."""
    learned = toxicity.train(*judged)
    rng = random.Random(2)
    slots = sorted({*learned.slots.tolist(), *rng.sample(range(1 << 18), 60_000)})
    made = toxicity.Model(-0.4, np.array(slots), np.array([rng.gauss(0, 0.2) for _ in slots]), np.array([[rng.gauss(0, 0.2) for _ in range(3)] for _ in slots]))
    short = [(i, t) for i, t in texts if not t or len(t) < 3000] + [(900, "Élan ÉLAN élan ÷× Àb 日本 Ünïted insulting grouping"), (901, "insulting w1"), (902, "grouping insulting")]
    docs = spark.createDataFrame(short, "doc_id long, text string")
    for model in (learned, made):
        weights, factors = dict(zip(model.slots.tolist(), model.weights)), dict(zip(model.slots.tolist(), model.factors))
        got = by_id(toxicity.score(docs, model), "score")
        for i, t in short:
            assert abs(got[i][0] - brute.machine_score(t, model.base, weights, factors)) < 1e-9


def test_labels_of_the_held_out_rows_are_not_read(judged):
    docs, labels = judged
    swapped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.train(docs, labels), toxicity.train(docs, swapped)
    assert a.base == b.base and (a.weights == b.weights).all()


def test_toxicity_of_awkward_tables(docs, awkward, empty, judged):
    labels = judged[1]
    none = toxicity.train(docs, labels.limit(0))
    assert {round(r["score"], 3) for r in toxicity.score(awkward, none).collect()} == {0.05}
    assert toxicity.drop_toxic(docs, labels.where("toxic = 0")).count() == docs.count()
    assert toxicity.score(empty, none).count() == 0
    odd = labels.selectExpr("CASE WHEN doc_id % 2 = 0 THEN doc_id END AS doc_id", "CASE WHEN doc_id % 3 > 0 THEN toxic END AS toxic")
    toxicity.score(awkward, toxicity.train(docs, odd.union(odd))).collect()


# 9 ---------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, f"http://www.Host{i % 4}.example.com:80/p/{i % 30}?q={i % 5}#x", f"<p>{'é' * (i % 9)}{i % 11}</p>") for i in range(700)]
    rows += [(9001, None, None), (9002, "", ""), (None, "http://a.b/", "<p>0</p>"), (9003, "no scheme\r\nat all", "x" * 200_000), (9004, "http://a.b/", None)]
    return spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, file string")


def test_archives_read_back_through_the_index(spark, pages, tmp_path):
    root = str(tmp_path / "warc")
    index = warc.write_index(warc.write_archives(pages, root), root)
    got = warc.read_captures(warc.lookup(warc.page_keys(pages), index), root, payloads=True).collect()
    want = {r["page_id"]: (r["html"] or "").encode() for r in pages.collect()}
    first = {}
    for page in sorted((p for p in want if p is not None)) + [None]:
        first.setdefault(want[page], page)
    assert len(got) == len(want)
    for r in got:
        payload, page = want[r["page_id"]], r["page_id"]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(payload), warc.payload_digest(payload))
        assert (r["record_type"], r["refers_to"]) == (("response", None) if first[payload] == page else ("revisit", first[payload]))
        assert r["payload"] == (payload if r["record_type"] == "response" else None)


def test_lookup_finds_what_is_there_and_nothing_else(spark, pages, tmp_path):
    root = str(tmp_path / "warc")
    captures = warc.write_archives(pages.where("page_id < 9000"), root)
    index = warc.write_index(captures, root)
    wanted = ["com,example,host1,www)/p/5?q=0", "com,example,host9,www)/", "zzz", "-"]
    keys = spark.createDataFrame([(k,) for k in wanted], "key string")
    found = {(r["key"], r["page_id"]) for r in warc.lookup(keys, index).collect()}
    assert found == {(r["key"], r["page_id"]) for r in captures.collect() if r["key"] in wanted} and found
    nothing = warc.write_index(captures.limit(0), root)
    assert warc.lookup(keys, nothing).count() == 0
    assert warc.write_archives(pages.limit(0), root).count() == 0


def test_url_keys():
    assert warc.url_key("HTTPS://user@WWW.Example.org:443/A?b#c") == "org,example,www)/A?b"
    assert warc.url_key("http://h.org:8080") == "org,h:8080)/"
    assert warc.url_key(None) == warc.url_key("") == "-"


# 10 --------------------------------------------------------------------------------------


def test_base_spans_equal_brute_force(spark):
    rng = random.Random(3)
    rows = ["".join(rng.choices("a1.@+ -()_%4 2é", k=80)) for _ in range(800)]
    rows += ["1.2.3.4.5.6.7.8 a@b.c_x@y.z", "4" * 16 + " 4111 1111 1111 1111-", "a@b@c.d", None, "", "001.0255.3.4 256.1.1.1"]
    rows += ["9" * 30_000, "a" * 100_000, "1.1." * 10_000, "x@" + "a." * 10_000 + "b", "é🙂 +1 (555) 123-4567 z@z.zz"]
    docs = spark.createDataFrame([(i, t, "q", 1) for i, t in enumerate(rows)], "doc_id long, text string, kind string, id int")
    got = by_id(pii.digest(pii.personal_data(docs)), "n_email", "n_ip", "n_card", "n_phone", "base_sha256")
    for i, t in enumerate(rows):
        spans = brute.base_spans(t)
        counts = tuple(sum(s.startswith(k) for s in spans) for k in ("email", "ip", "card", "phone"))
        assert got[i] == (*counts, brute.sha(spans)), (i, (t or "")[:80])


def test_contexts_lead_to_unseen_identifiers(spark):
    seeds = [f"member-no: {x} joined today" for x in ("a1@x.org", "b2@x.org", "c3@y.org", "d4@y.org")]
    rows = [*seeds, "member-no: kt-99812-z joined", "see kt-99812-z", "ref: kt-99812-z", "ref: kt-7-abc", "ref: kt-88-abc", "the 12345 cats", "the cat"]
    rows += ["ref: a1@x.org", "ref: b2@x.org", "ref: zq-1-zq"] + ["the dog"] * 5
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = by_id(pii.digest(pii.personal_data(docs)), "spans", "n_email")
    assert got[0] == ("email:11:19", 1) and got[4] == ("email:11:21", 0) and got[5] == ("email:4:14", 0)
    assert got[9] == ("", 0)


def bootstrap_rows():
    rng = random.Random(11)
    base = [f"u{i}@mail.org" for i in range(12)] + ["10.0.0.7", "+1 (017) 555-7713", "4111 1111 1111 1111"]
    rows = []
    for hop in range(7):  # values of one hop stand after its context and after the next one's
        own = [f"id-{hop}-{i}xx" for i in range(4)]
        seen = base[:6] if hop == 0 else [f"id-{hop - 1}-{i}xx" for i in range(4)]
        rows += [f"Ctx{hop}: {v} end" for v in seen * 30] + [f"say ctx{hop}: ({v})." for v in own]
    rows += [f"{rng.choice(['mail', 'ref', 'the', 'ctx3:'])} {rng.choice(base + ['12345', 'no1', 'abc', 'x@'])} {rng.choice(base)}" for _ in range(150)]
    rows += ["ctx0:" + " " * 500 + "id-0-0xx", "w" * 300 + "7 " + "long" * 100 + " id-9-9xx", "id-0-1xx", "", None, "ctx0: " + "\t\n" * 150 + "Id-0-2xx,"]
    rows.append(" ".join(f"ctx0: a{i}@b.org,c{i}@d.org" for i in range(600)))  # many spans in one text
    return rows


def test_bootstrap_equals_brute_force(spark):
    rows = list(enumerate(bootstrap_rows()))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = brute.personal(rows)
    got = by_id(pii.digest(pii.personal_data(docs)), "spans")
    assert {d: s for d, (s,) in got.items()} == {d: ",".join(s) for d, s in want.items()}
    hops = {v for v in range(7) if any(s for d, s in want.items() if rows[d][1] == f"say ctx{v}: (id-{v}-0xx).")}
    assert hops >= {0, 1, 2, 3, 4}  # farther than three hops from a seed


@pytest.mark.parametrize("kind", ["phone", "card"])
def test_spaced_numbers_are_seeds(spark, kind):
    numbers = {
        "phone": [f"+1 (017) 555-771{i}" for i in range(4)],
        "card": ["4111 1111 1111 1111", "4012 8888 8888 1881", "5555 5555 5555 4444", "5105 1051 0510 5100"],
    }[kind]
    rows = [f"number: {x} today" for x in numbers] + ["number: kt-99812-z today", "see kt-99812-z", "the 12345 cats"]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = by_id(pii.digest(pii.personal_data(docs)), "spans")
    assert [got[i][0] for i in (4, 5, 6)] == [f"{kind}:8:18", f"{kind}:4:14", ""]


def test_personal_data_of_awkward_tables(awkward, empty):
    assert pii.personal_data(empty).count() == 0
    got = pii.digest(pii.personal_data(awkward)).collect()
    assert len(got) == 8 and {r["base_sha256"] for r in got} == {brute.sha([])}


# all -------------------------------------------------------------------------------------


def test_columns_named_like_inner_ones(spark, texts, items):
    names = ["__id", "__hash", "__group", "__n", "__text_hash", "__at", "__source", "cdf", "doc", "name", "id", "hash", "group", "n", "hit_id", "of", "at", "source"]
    rows = [(i, t, *[f"v{k}" for k in range(len(names))]) for i, t in texts[:60]]
    docs = spark.createDataFrame(rows, ", ".join(["doc_id long", "text string", *[f"`{n}` string" for n in names]]))
    values = {r["doc_id"]: tuple(r) for r in docs.collect()}
    for out in (minhash.keep_one_per_group(docs), decontaminate.drop_contaminated(docs, items), mixing.mixed(docs, mixing.Mix(size=3.0))):
        got = out.collect()
        assert len(got) > 20 and out.columns[: len(docs.columns)] == docs.columns
        assert all(tuple(r)[: len(docs.columns)] == values[r["doc_id"]] for r in got)
    lines = line_runs.drop_repeated_lines(docs)
    assert lines.columns == docs.columns and all(tuple(r)[2:] == values[r["doc_id"]][2:] for r in lines.collect())


def test_joins_of_hot_rows_are_split(spark):
    """A frequent line and a node with very many links: the join of their rows is split by size."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "16",
        "spark.sql.files.maxPartitionBytes": "64k",
        "spark.sql.files.openCostInBytes": "1k",
    }
    old = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        place = F.struct(F.col("id").alias("id"), F.lit(0).cast("long").alias("h"))
        a = F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).cast("long")
        rows = spark.range(60_000, numPartitions=12).select(place.alias("k"), F.lit(0).alias("n"), a.alias("a"), a.alias("b"))
        joined = line_runs._repeated(rows)
        joined.write.format("noop").mode("overwrite").save()
        hot = joined._jdf.queryExecution()
        joined.collect()
        assert "skew=true" in hot.executedPlan().toString() or "isSkewJoin=true" in hot.executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
