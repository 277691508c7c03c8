"""Training-data operators against brute force, and their edge cases: nulls, empty and long texts, ties, repeats, empty tables, clashing names."""

import math
import pathlib
import random
import re
import tracemalloc
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerlens.llm import ann, components, decontaminate, mixing, secret_scan, sharding, simhash, token_counts, token_store, toxicity, url_filter
from ledgerlens.llm.wavelet import WaveletFile, build
from ledgerlens.operators import stability

DOCS = "doc_id long, text string, source string"
# Columns whose names the operators use for their own results.
CLASHING = ("size", "fp", "fingerprint", "k", "t", "h", "src", "slot", "n_tokens", "start", "severity", "spans", "_copies", "doc")
LONG = "word " * 60_000 + "x" * 50_000
ODD = [
    (1, "the quick brown fox jumps over the lazy dog", "a"), (2, None, "b"), (3, "", None), (4, LONG, "a"),
    (5, "don't  stop\n\nnow <|endoftext|> ſ K é ẞ 日本 \x1c\x85\u00a0 x", "c"), (5, "don't  stop\n\nnow <|endoftext|> ſ K é ẞ 日本 \x1c\x85\u00a0 x", "c"),
    (None, "no id at all here", "b"), (7, " \t ", "a"),
]


def frame(spark, rows, schema=DOCS, clashing=True):
    df = spark.createDataFrame(rows, schema)
    for name in CLASHING if clashing else ():
        df = df.withColumn(name, F.lit(-1))
    return df


def rows_of(df, *names):
    return sorted(((tuple(r) if not names else tuple(r[n] for n in names)) for r in df.collect()), key=repr)


def test_token_counts_equal_the_library(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = token_counts.library(path)
    rng = random.Random(3)
    pieces = ["'s", "'ve", "Word", " ", "  ", "\n", "12", "٣", "é", "ǅ", "\u0558", "\U00010940", "!?", "<|endoftext|>", "\u00a0", "日", "🙂", "\x1c"]
    rows = ODD + [(100 + i, "".join(rng.choice(pieces) for _ in range(rng.randint(1, 12))), "r") for i in range(150)]
    got = rows_of(token_counts.count_tokens(frame(spark, rows), path), "doc_id", "n_bytes", "n_tokens", "over_limit")
    want = []
    for key, text, _ in rows:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        want.append((key, len((text or "").encode()), n, n > 1024))
    assert got == sorted(want, key=repr)
    assert token_counts.count_tokens(frame(spark, []), path).count() == 0


def test_whole_tokens_are_single_tokens():
    path = public_tokenizers.path("byte_bpe_50k.json")
    whole = token_counts.whole_tokens(path)
    assert len(whole) > 40_000 and " the" in whole
    assert all(len(e.ids) == 1 for e in token_counts.library(path, True).encode_batch(sorted(whole)[::50]))


def test_shards_take_turns(spark):
    names = sharding.shard_names(7)
    owner = sharding.fill(names, 701)
    counts = np.bincount(owner, minlength=7)
    assert counts.max() - counts.min() <= 1
    fewer = sharding.fill(names[:-1], 701)
    assert sum(a != b for a, b in zip(owner, fewer) if a != 6) < 0.2 * 701
    with pytest.raises(ValueError):
        sharding.fill(names, 700)
    got = sharding.place(frame(spark, ODD), shards=names, slots=701).collect()
    assert len(got) == len(ODD) and {r["shard"] for r in got} <= set(names)
    assert len({(r["slot"], r["shard"]) for r in got if r["doc_id"] == 5}) == 1
    assert sharding.place(frame(spark, []), slots=701).count() == 0


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, ids):
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                parent[root(i)] = root(j)
    least = {}
    for i, key in enumerate(ids):
        if key is not None:
            least[root(i)] = min(key, least.get(root(i), key))
    return [least.get(root(i)) for i in range(len(prints))]


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(5)
    vocabulary = [f"W{i}" for i in range(300)]
    base = [rng.choice(vocabulary) for _ in range(300)]
    rows = list(ODD)
    for i in range(60):
        words = list(base)
        for _ in range(i % 6):
            words[rng.randrange(300)] = rng.choice(vocabulary)
        rows.append((200 + i, " ".join(words), "s"))
    rows += [(300 + i, " ".join(rng.choice(vocabulary) for _ in range(40)), "s") for i in range(40)]
    got = rows_of(simhash.near_duplicates(frame(spark, rows)), "doc_id", "fingerprint", "component_id")
    prints = [plain_fingerprint(t) for _, t, _ in rows]
    groups = plain_components(prints, [k for k, _, _ in rows])
    assert got == sorted(((k, f"{p:016x}", g) for (k, _, _), p, g in zip(rows, prints, groups)), key=repr)
    assert simhash.near_duplicates(frame(spark, [])).count() == 0


@pytest.mark.parametrize("block", [8, 2048])
def test_links_lose_nothing_in_blocks(spark, block):
    rng = random.Random(block)
    prints = {0}
    for _ in range(150):
        one = rng.choice(sorted(prints))
        for _ in range(rng.randint(1, 7)):
            one ^= 1 << rng.randrange(64)
        prints.add(one)
    prints = sorted(prints)
    fps = spark.createDataFrame([(simhash._signed(p),) for p in prints], "fp long")
    found = {r["node"]: r["root"] for r in components.components(simhash.links(fps, block)).collect()}
    want = plain_components(prints, list(range(len(prints))))
    roots = [found.get(simhash._signed(p), simhash._signed(p)) for p in prints]
    same = {}
    for w, r in zip(want, roots):
        assert same.setdefault(w, r) == r
    assert len(set(roots)) == len(set(want))


def test_long_chain_is_one_component(spark):
    links = spark.range(300).selectExpr("id as a", "id + 1 as b")
    got = components.components(links).collect()
    assert len(got) == 301 and {r["root"] for r in got} == {0}


@pytest.fixture
def many_partitions(spark):
    """A session of 40 shuffle partitions that stay as they are; gives the files of whole tables written so far."""
    names = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    top = pathlib.Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    yield lambda: sum(1 for p in top.rglob("part-*"))
    for name, value in before.items():
        spark.conf.set(name, value)


def test_rounds_over_few_links_write_few_files(spark, many_partitions):
    before = many_partitions()
    got = components.components(spark.range(300).selectExpr("id as a", "id + 1 as b")).collect()
    assert len(got) == 301 and {r["root"] for r in got} == {0}
    # The first table's size is not known yet; each of some ten rounds writes two more.
    assert many_partitions() - before < 3 * 40


def test_tables_of_sources_take_few_files(spark, many_partitions):
    docs = frame(spark, [(i, "word " * (i % 7), "abcd"[i % 4]) for i in range(200)])
    before = many_partitions()
    assert mixing.thresholds(docs).count() == 4
    assert many_partitions() - before < 2 * 40


def test_a_table_of_known_size_takes_files_by_its_rows(spark):
    rows = spark.range(0, 90_000, numPartitions=9)
    for most, files in ((None, 9), (90_000, 5), (10_000_000, 9), (0, 1)):
        kept = stability.materialise(rows, most)
        assert kept.rdd.getNumPartitions() == files
        assert sorted(r["id"] for r in kept.collect()) == list(range(90_000))


def test_alignment_matches_plain_table():
    rng = random.Random(9)
    for _ in range(40):
        a = np.array([rng.randint(1, 5) for _ in range(rng.randint(1, 12))])
        b = np.array([rng.randint(0, 5) for _ in range(rng.randint(1, 20))])
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                step = 2 if a[i - 1] == b[j - 1] else -1
                table[i][j] = max(0, table[i - 1][j - 1] + step, table[i - 1][j] - 1, table[i][j - 1] - 1)
        score, equal, first, last = decontaminate.align(a, b)
        assert score == max(max(r) for r in table) and 0 <= first <= last <= len(b) and 2 * equal >= score


def test_contaminated_texts_are_found(spark):
    rng = random.Random(11)
    vocabulary = [f"v{i}" for i in range(3000)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(30))) for i in range(20)] + [(90, None), (91, ""), (92, "too short")]
    filler = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    rows, want = list(ODD), set()
    for i in range(20):
        words = items[i][1].split()
        if i % 3 == 1:
            for at in range(3, 30, 7):
                words[at] = "changed"
        if i % 3 == 2:
            del words[10], words[20]
        rows.append((100 + i, f"{filler(200)} {' '.join(words).upper()}, {filler(50)}", "x"))
        want.add((100 + i, i))
    rows += [(200 + i, filler(300), "x") for i in range(30)]
    docs, tests = frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contaminated(docs, tests, chunk_words=100).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want
    kept = decontaminate.clean(docs, tests)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 20
    assert decontaminate.contaminated(frame(spark, []), tests).count() == 0
    assert decontaminate.contaminated(docs, tests.limit(0)).count() == 0


@pytest.mark.parametrize("step", [5, 6])
def test_edited_copies_are_found_beside_verbatim_ones(spark, step):
    """Intact runs of four or five words, whose n-grams are more common than those that only verbatim copies hold."""
    rng = random.Random(17)
    items = [(i, " ".join(f"v{rng.randrange(3000)}" for _ in range(60))) for i in range(8)]
    edited = [(100 + i, " ".join("changed" if at % step == step - 1 else w for at, w in enumerate(t.split())), "x") for i, t in items]
    verbatim = [(200 + i, t, "x") for i, t in items[:4]]
    tests = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contaminated(frame(spark, edited + verbatim), tests)
    assert rows_of(got, "doc_id", "item_id") == sorted([(100 + i, i) for i in range(8)] + [(200 + i, i) for i in range(4)], key=repr)


def test_ordinal_slope_equals_differences():
    rng = np.random.default_rng(43)
    count, width = 30, 5
    row, column = np.repeat(np.arange(count), 2), rng.integers(0, width, 2 * count)
    value, grade = rng.random(2 * count), rng.integers(0, toxicity.GRADES + 1, count)
    theta = np.concatenate([rng.normal(size=width), [-0.3], rng.normal(size=toxicity.GRADES - 1) * 0.3])
    at = lambda t: toxicity.loss_and_slope(t, row, column, value, grade, width, 0.01)
    # The loss itself, plainly: ordered logistic chances of every row's grade.
    weights, cuts = theta[:width], theta[width] + np.concatenate([[0.0], np.cumsum(np.exp(theta[width + 1:]))])
    plain = 0.0
    for i in range(count):
        s = sum(value[j] * weights[column[j]] for j in range(2 * count) if row[j] == i)
        above = [1.0, *(1 / (1 + math.exp(c - s)) for c in cuts), 0.0]
        plain -= math.log(above[grade[i]] - above[grade[i] + 1])
    loss, slope = at(theta)
    assert loss == pytest.approx(plain / count + 0.005 * float(weights @ weights), rel=1e-12)
    for i in range(len(theta)):
        step = np.zeros_like(theta)
        step[i] = 1e-6
        assert slope[i] == pytest.approx((at(theta + step)[0] - at(theta - step)[0]) / 2e-6, abs=1e-7)


def test_labelled_sample_is_bounded_whatever_repeats(spark):
    rows = [(7, f"text {i}", "s") for i in range(3000)] + [(i, f"other {i}", "s") for i in range(100, 160)]
    labels = spark.createDataFrame([(7, 1), (7, 0), (None, 1), (9999, 1)] + [(i, i % 2) for i in range(100, 160)], "doc_id long, toxic int")
    got = toxicity.labelled_sample(frame(spark, rows), labels, "doc_id", "text", "toxic", 10).collect()
    assert len(got) <= 10
    whole = toxicity.labelled_sample(frame(spark, rows), labels, "doc_id", "text", "toxic", 1000).collect()
    assert len(whole) == 61 and sum(r["text"].startswith("text") for r in whole) == 1
    assert [r["toxic"] for r in whole if r["text"].startswith("text")] == [1]


def toxic_rows():
    rng = random.Random(13)
    words, bad = [f"w{i}" for i in range(400)], ["vile", "nastyness", "nastyful"]
    rows, labels = list(ODD), []
    for i in range(400):
        text = [rng.choice(words) for _ in range(rng.randint(20, 80))]
        if i % 5 == 0:
            text += [rng.choice(bad) for _ in range(rng.randint(3, 8))]
        rows.append((1000 + i, " ".join(text), "s"))
        if i % 2 == 0:
            labels.append((1000 + i, int(i % 5 == 0)))
    return rows, labels + [(None, 1), (1000, None), (4, 0)]


def test_toxicity_on_held_out_rows(spark):
    rows, labels = toxic_rows()
    docs, marks = frame(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(docs, marks)
    assert list(model.thresholds) == sorted(model.thresholds)
    got = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    held = [k for k in got if k and k >= 1000 and k % 2 == 1]
    assert np.mean([got[k]["toxic"] == (k % 5 == 0) for k in held]) > 0.97
    assert all(math.isclose(got[k]["severity"], sum(model.chances(dict((a, b) for a, b, _ in rows)[k]))) for k in held[:20])
    kept = toxicity.keep_clean(docs, marks)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {k for k, r in got.items() if not r["toxic"]}
    nothing = toxicity.fit(docs, marks.where("toxic = 0"))
    assert not toxicity.score(docs, nothing).where("toxic").count()
    assert toxicity.score(frame(spark, []), model).count() == 0
    assert not toxicity.fit(frame(spark, []), marks).weights


def test_mix_equals_sql_with_hot_and_null_sources(spark):
    rng = random.Random(17)
    rows = list(ODD) + [(50 + i, "w " * rng.randint(0, 40), rng.choice(["a", "a", "a", "Z", "é", "b", None])) for i in range(300)]
    docs = frame(spark, rows)
    got = rows_of(mixing.mix(docs), "doc_id", "size", "source_size", "target", "taken")
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text", "source").toArrow())
    want = con.sql(mixing.sql())
    assert got == sorted([tuple(r) for r in want.project("doc_id, size, source_size, target, taken").fetchall()], key=repr)
    assert math.isclose(sum({r[3] for r in got}), sum(r[1] for r in got)) and all(r[4] <= 3 * r[1] for r in got)
    taken = mixing.take(docs)
    assert taken.columns == docs.columns
    words = taken.groupBy("doc_id").agg(F.sum(mixing.word_count("text")).alias("n")).where("n > 0 and doc_id is not null and doc_id <> 5")
    assert dict(words.collect()) == {r[0]: r[4] for r in got if r[4] and r[0] not in (None, 5)}
    assert mixing.mix(frame(spark, [])).count() == 0


def test_wavelet_file_answers_queries():
    rng = np.random.default_rng(19)
    for ids in (np.zeros(0, int), np.array([7]), np.zeros(10, int), rng.integers(0, 50, 150_000)):
        file = WaveletFile(build(ids))
        assert (file.all() == ids).all()
        for token in (0, 7, 49, 1_000_000):
            where = np.flatnonzero(ids == token)
            assert file.count(token) == len(where)
            assert file.count(token, 3, max(3, len(ids) // 2)) == ((where >= 3) & (where < max(3, len(ids) // 2))).sum()
            assert file.occurrences(token, 0, min(200, len(ids))) == where[where < 200].tolist()
            if len(where):
                assert file.select(token, len(where) - 1) == where[-1]
        for at in range(0, len(ids), max(1, len(ids) // 20)):
            assert file.access(at) == ids[at]


def plain_digest(rows, library):
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    start, out = 0, []
    for key, text, *_ in ordered:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        out.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_token_store_round_trip(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    rng = random.Random(23)
    pieces = ["It's", "ẞ", "Σας", "ﬁ", "é", "e\u0301", "x<|startoftext|>y", "12ab", "日本", "!!'s", "µ", "÷", "\x85", "we'll''d", " ", "\n", "ÀÖ"]
    rows = list(ODD) + [(60 + i, "".join(rng.choice(pieces) for _ in range(rng.randint(0, 10))), "s") for i in range(100)]
    got = rows_of(token_store.round_trip(frame(spark, rows), path), "doc_id", "start", "n_tokens", "ids_crc32")
    assert got == sorted(plain_digest(rows, token_counts.library(path)), key=repr)
    assert token_store.round_trip(frame(spark, []), path).count() == 0


def test_words_are_looked_up_once_for_many_texts(monkeypatch):
    path, rng = public_tokenizers.path("word_bpe_49k.json"), random.Random(37)
    plain = token_counts.library(path)
    pool = ["It's", "ẞ", "x<|endoftext|>y", "12ab", "日本", "é" * 70, "z" * 99, "we'll''d", "µ", "!!'s", "\x1c", "<|startoftext|>", "ÀÖ"]
    texts = [None, "", " \t", *(rng.choice(["", " "]) + rng.choice([" ", "\n\x0b ", "\x0c"]).join(
        rng.choice(pool) if rng.random() < 0.6 else f"w{rng.randrange(40)}é{rng.randrange(9)}" for _ in range(rng.randrange(30))) for _ in range(200))]
    for kept, chunk in ((800_000, 1 << 22), (20, 300)):
        monkeypatch.setattr(token_store, "KEPT", kept)
        monkeypatch.setattr(token_store, "CHUNK_BYTES", chunk)
        encoder, column, looked_up = token_store.WordEncoder(path), pa.array(texts), []
        encoder.words = type("Words", (dict,), {"get": lambda self, word: looked_up.append(word) or dict.get(self, word)})()
        ids, counts, chunks = [], [], list(token_store._chunks(column))
        for begin, end in chunks:
            some, each = encoder.encode(column.slice(begin, end - begin))
            ids += some.tolist()
            counts += each.tolist()
        want = [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert counts == [len(w) for w in want] and ids == [i for w in want for i in w]
        if kept == 20:
            assert len(chunks) > 5 and [b for b, _ in chunks[1:]] == [e for _, e in chunks[:-1]] and chunks[-1][1] == len(texts)
        else:
            assert len(chunks) == 1 and len(looked_up) == len(set(looked_up))
        assert all(len(w) <= token_counts.LONGEST_KEPT for w in [*encoder.words, *encoder.pieces])


def test_words_remembered_and_work_on_texts_stay_small():
    encoder, letters = token_store.WordEncoder(public_tokenizers.path("word_bpe_49k.json")), "abcdefghijklmnopqrstuvwxyz"
    word = lambda i: "".join(letters[i // 26**k % 26] for k in range(4)) + "zq"
    rare = [" ".join(map(word, range(i, i + 100))) for i in range(0, 450_000, 100)]
    many = ["a b " * 500] * 4200
    traced = []
    for texts in (rare, many):
        column = pa.array(texts)
        tracemalloc.start()
        for begin, end in token_store._chunks(column):
            ids, _ = encoder.encode(column.slice(begin, end - begin))
        traced.append([size >> 20 for size in tracemalloc.get_traced_memory()])
        tracemalloc.stop()
    assert max(len(encoder.words), len(encoder.pieces)) <= 400_000 and len(encoder.words) >= 290_000
    # MB: what stays after the rare words, and the most that common ones take.
    assert traced[0][0] < 100 and traced[1][1] < 30


def test_shards_end_with_the_text_that_fills_them(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_store, "CHUNK_BYTES", 40)
    rng, path = random.Random(41), public_tokenizers.path("word_bpe_49k.json")
    rows = [(i if i else None, " ".join(rng.choice("abc") for _ in range(rng.randrange(12))), "s") for i in range(60)]
    token_store.write(frame(spark, rows).coalesce(1), str(tmp_path / "s"), path, shard_tokens=20)
    shards = spark.read.parquet(str(tmp_path / "s")).collect()
    lengths = {(r["part"], r["shard"]): np.frombuffer(r["lengths"], "<u4") for r in shards}
    last = {p: max(s for q, s in lengths if q == p) for p, _ in lengths}
    for (part, shard), each in lengths.items():
        assert each[:-1].sum() < 20 and (each.sum() >= 20 or shard == last[part])
    got = rows_of(token_store.digest(spark, str(tmp_path / "s")), "doc_id", "start", "n_tokens", "ids_crc32")
    assert got == sorted(plain_digest(rows, token_counts.library(path)), key=repr)


def test_long_passages_of_longer_items_are_found(spark):
    rng = random.Random(23)
    some = lambda n: [f"v{rng.randrange(3000)}" for _ in range(n)]
    items = {i: some(length) for i, length in enumerate((59, 500, 500, 500, 500))}
    passages = {0: items[0][20:45], 1: items[1][100:320], 2: items[2][-13:], 3: items[3][50:62]}
    passages[4] = [w if at % 6 else "changed" for at, w in enumerate(items[4][200:240])]
    # A looser alignment of a higher score, but below half of the item, beside a long passage.
    passages[5] = [w if at % 3 else "changed" for at, w in enumerate(items[1][:150])] + some(40) + items[1][400:414]
    docs = frame(spark, [(100 + i, " ".join(some(100) + words + some(150)), "x") for i, words in passages.items()])
    tests = spark.createDataFrame([(i, " ".join(words)) for i, words in items.items()], "item_id long, text string")
    got = rows_of(decontaminate.contaminated(docs, tests), "doc_id", "item_id")
    assert got == [(100, 0), (101, 1), (102, 2), (104, 4), (105, 1)]
    assert rows_of(decontaminate.clean(docs, tests), "doc_id") == [(103,)]


def test_nearest_finds_most_and_scores_exactly(spark):
    rng = np.random.default_rng(29)
    vectors = rng.normal(size=(1500, 32)) * rng.uniform(0.5, 2, size=(1500, 1))
    vectors[500:1000] = vectors[500]
    rows = [(i, v.astype(np.float32).tolist(), 1) for i, v in enumerate(vectors)]
    rows += [(2000, None, 1), (2020, [0.0] * 32, 1), (2040, [float("nan")] * 32, 1), (2060, [None] + [1.0] * 31, 1), (None, [1.0] * 32, 1), (20, rows[20][1], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    got = {}
    for r in ann.nearest(df).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(got) == list(range(0, 1500, 20))
    exact = np.array([r[1] for r in rows[:1500]], np.float64)
    hits = total = 0
    for query, found in got.items():
        scores = exact @ exact[query]
        assert [r[0] for r in found] == list(range(1, len(found) + 1)) and len(found) == 20
        assert all(math.isclose(s, scores[v], rel_tol=1e-12) and v != query for _, v, s in found)
        assert [(-s, v) for _, v, s in found] == sorted((-s, v) for _, v, s in found)
        scores[query] = -np.inf
        best = np.lexsort((np.arange(1500), -np.round(scores, 10)))[:20]
        hits, total = hits + len({v for _, v, _ in found} & set(best.tolist())), total + 20
    assert hits / total >= 0.9
    assert ann.nearest(df.limit(0)).count() == 0


def test_nearest_of_small_classes_long_vectors_and_lone_queries(spark):
    """Few vectors of a length, norms that differ much, and a query that points away from all others."""
    rng = np.random.default_rng(31)
    vectors = [*rng.normal(size=(10, 16)), *rng.normal(size=(60, 24))]
    few = len(vectors)
    vectors += list(rng.normal(size=(2000, 64)) * rng.lognormal(0, 1, size=(2000, 1)))
    lone = len(vectors)
    vectors += list(np.eye(32)[0] + rng.normal(size=(159, 32)) * 0.01)
    vectors += [-np.eye(32)[0]]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest(df, every=1, candidates=100).where(f"query_id < {few} or query_id % 20 = 0 or query_id = {len(vectors) - 1}").collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = total = 0
    for query in [i for i in range(len(vectors)) if i < few or i % 20 == 0 or i == len(vectors) - 1]:
        own = [i for i, v in enumerate(vectors) if len(v) == len(vectors[query]) and i != query]
        best = {i for _, i in sorted((-float(vectors[i] @ vectors[query]), i) for i in own)[:20]}
        assert len(got[query]) == min(20, len(own))
        if query < few or query == len(vectors) - 1:
            assert got[query] == best
        elif query < lone:
            hits, total = hits + len(got[query] & best), total + 20
    assert hits / total >= 0.97


def nearest_lists(df, **settings):
    got = {}
    for r in ann.nearest(df, **settings).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return got


def plain_nearest(vectors, query, k=20):
    with np.errstate(all="ignore"):
        scores = (vectors * vectors[query]).sum(axis=1)
    scores = np.where(np.isnan(scores), -np.finfo(float).max, scores)
    return [(i, scores[i]) for i in sorted((i for i in range(len(vectors)) if i != query), key=lambda i: (-scores[i], i))[:k]]


@pytest.mark.parametrize("kind", ["integers", "large", "small", "one axis"])
def test_nearest_breaks_ties_by_id_and_survives_extreme_norms(spark, kind):
    """Different vectors with equal products at every border; products beyond the range of doubles."""
    rng = np.random.default_rng(37)
    vectors = {
        "integers": rng.integers(-3, 4, (900, 8)).astype(float),
        "large": np.array([[1e200 * (i + 1), 1.0] if i % 3 else [-1e200, 1e200] for i in range(60)]),
        "small": np.array([[1e-200 * (i + 1), 1e-210] for i in range(60)]),
        "one axis": np.array([[1.0 + i % 2, 0.0] for i in range(70)]),
    }[kind]
    vectors[(vectors == 0).all(axis=1)] = 1.0
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    for name in CLASHING + ("band", "step", "v", "qid", "vid", "rank", "query_id"):
        df = df.withColumn(name, F.lit("x"))
    got = nearest_lists(df)
    assert set(got) == set(range(0, len(vectors), 20))
    for query, found in got.items():
        assert found == plain_nearest(vectors, query)


@pytest.mark.parametrize("spread", [0.0, 0.5])
def test_nearest_finds_most_at_the_registered_settings(spark, spread):
    rng = np.random.default_rng(41)
    vectors = rng.normal(size=(6000, 64))
    vectors *= np.exp(rng.normal(size=(6000, 1)) * spread) / np.linalg.norm(vectors, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    got = nearest_lists(df)
    hits = sum(len({v for v, _ in found} & {v for v, _ in plain_nearest(vectors, query)}) for query, found in got.items())
    assert hits / (20 * len(got)) >= 0.95
    if not spread:
        whole = nearest_lists(df.where("vec_id < 1500"), probes=1.0)
        assert all([v for v, _ in found] == [v for v, _ in plain_nearest(vectors[:1500], query)] for query, found in whole.items())


URLS = [
    (1, "http://a.ORG/x?y"), (2, "https://www.example.org/es/1"), (3, "https://example.org/en/12#t"), (4, "ftp://badexample.org/es/"), (5, "http://org"),
    (6, "http://news.com/fr/"), (7, "http://com/de/x"), (8, "http://other.net/de/x"), (9, None), (10, "no scheme"), (11, ""), (12, "x://"),
    (12, "x://"), (None, "http://b.org/"), (13, "http://long.net/" + "q" * 20_000), (14, "http://é.net/ß?x=1"), (15, "//a.com/fr/"),
]


def test_url_rules_and_model_equal_sql(spark):
    pages = spark.createDataFrame(URLS + [(100 + i, f"http://h{i % 9}.{'org' if i % 2 else 'com/de'}/p{i}") for i in range(80)], "page_id long, url string")
    pages = pages.withColumn("host", F.lit(1)).withColumn("k", F.lit(1)).withColumn("rule", F.lit(1))
    got = rows_of(url_filter.judge(pages), "page_id", "host", "path", "rule", "verdict")
    con = duckdb.connect()
    con.register("pages", pages.select("page_id", "url").toArrow())
    assert got == sorted([tuple(r) for r in con.sql(url_filter.sql()).project("page_id, host, path, rule, verdict").fetchall()], key=repr)
    by_id = {r[0]: r for r in got}
    assert by_id[1][1:] == ("a.org", "/x", "org/", "allow") and by_id[2][3:] == ("example.org/es/", "block")
    assert by_id[3][3:] == ("example.org/en/1", "block") and by_id[4][3] == "org/" and by_id[5][3] is None
    assert by_id[9][1:4] == ("", "", None) and len(got) == pages.count()
    assert url_filter.judge(pages.limit(0)).count() == 0


def test_every_part_of_a_url_is_scored(spark):
    """Scheme, query, fragment and URLs without a scheme count; clashing column names do no harm."""
    known = [f"http://good{i}.org/fine?list=apple#top" for i in range(60)] + [f"http://bad{i}.com/de/fine?casino=spin#slots" for i in range(60)]
    asked = ["http://n.net/fine?list=apple#top", "http://n.net/fine?casino=spin#slots", "http://n.net/", "list=apple", "casino=spin#slots", "mailto:x@y"]
    pages = spark.createDataFrame(list(enumerate(known + asked)), "page_id long, url string")
    for name in ("u", "s", "copies", "held", "ruled", "score", "gram", "mean", "path", "verdict"):
        pages = pages.withColumn(name, F.lit("x"))
    got = {r["page_id"]: r for r in url_filter.judge(pages).collect()}
    scores = [got[len(known) + i]["score"] for i in range(len(asked))]
    assert scores[0] > scores[1] and scores[3] > scores[4] and len(set(scores)) == len(scores) and 0.0 not in scores
    assert [got[len(known) + i]["verdict"] for i in (1, 3, 4)] == ["block", "allow", "block"]


def plain_spans(text):
    found = []
    for place, rule in enumerate(secret_scan.RULES):
        for m in re.finditer(rule.pattern, text or "", re.I | re.A if rule.any_case else 0):
            if len(m[rule.group]) >= rule.least:
                found.append((m.start(), place, m.end(), rule.kind))
    return [f"{kind}:{start}:{end}" for start, _, end, kind in sorted(found)]


def test_secrets_equal_plain_search(spark):
    rng = random.Random(31)
    pieces = ["token=", "passwd", " : ", "API_KEY='", "abcdefgh12", "AKIA", "ABCD1234EFGH", "0123456789abcdef" * 2, "deadbeef", " ", "\n", "é🙂", "secret=secret:",
              "-----BEGIN RSA PRIVATE KEY-----", "ghp_", "x" * 36, "eyJabcdefghij.", "abcdefghijk.", "=", "xoxb-", "1234567890ab"]
    rows = list(ODD) + [(70 + i, "".join(rng.choice(pieces) for _ in range(rng.randint(1, 15))), "s") for i in range(250)]
    rows.append((999, ("ab" * 20 + " ") * 3000, "s"))
    got = rows_of(secret_scan.scan(frame(spark, rows)), "doc_id", "spans", "n_assign", "n_access", "n_hex")
    want = []
    for key, text, _ in rows:
        spans = plain_spans(text)
        want.append((key, ",".join(spans), *(sum(s.startswith(f"{k}:") for s in spans) for k in ("assign", "access", "hex"))))
    assert got == sorted(want, key=repr)
    assert secret_scan.scan(frame(spark, [])).count() == 0


def test_trigram_queries():
    query = secret_scan.trigram_query
    assert query("AKIA[A-Z0-9]+") == {frozenset({"aki", "kia"})}
    assert query("[0-9a-f]+") == secret_scan.ANY and query("(ab|cd)x?") == secret_scan.ANY
    assert query("api_?key") == {frozenset({"api", "pik", "ike", "key"}), frozenset({"api", "pi_", "i_k", "_ke", "key"})}
    assert query("(foo|barn)[0-9]*zed") == {frozenset({"foo", "zed"}), frozenset({"bar", "arn", "zed"})}
