"""Vector codes, prefix tries and prefix BPE against brute force, and their edge cases."""

import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from ledgerlens.llm import ball_codes, prefix_bpe, prefix_trie
from test_operators import ODD, frame, rows_of


# --- vector codes ----------------------------------------------------------------------------

def plain_codes(rows, parts=8, entries=16, rounds=6, scale=4096):
    """Every part against every entry, in whole numbers of any size."""
    rows = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    width = max(1, -(-max((len(r[1]) for r in rows), default=0) // parts))
    cut = {}
    for i, (_, v, _) in enumerate(rows):
        whole = [math.floor(scale * x) for x in v] + [0] * (width * parts - len(v))
        cut[i] = [whole[p * width:(p + 1) * width] for p in range(parts)]
    first = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][1]))[:entries]
    books = [[list(cut[i][p]) for i in first] for p in range(parts)]
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))

    def assign():
        return [[min((gap(cut[i][p], e), j) for j, e in enumerate(books[p])) for p in range(parts)] for i in range(len(rows))]

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for j in range(len(books[p])):
                mine = [cut[i][p] for i in range(len(rows)) if found[i][p][1] == j]
                if mine:
                    books[p][j] = [sum(column) // len(mine) for column in zip(*mine)]
    found = assign()
    errors = [sum(d for d, _ in one) for one in found]
    by_label = {}
    for (_, _, label), e in zip(rows, errors):
        by_label[label] = by_label.get(label, 0) + e
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    return sorted(((r[0], "".join(f"{j:02x}" for _, j in one), e, by_label[r[2]], digest) for r, one, e in zip(rows, found, errors)), key=repr)


VECTORS = "vec_id long, embedding array<float>, label int"


def vector_frame(spark, rows):
    df = spark.createDataFrame(rows, VECTORS)
    for name in ("code", "error", "ids", "raw", "of", "v", "label_error"):
        df = df.withColumn(name, F.lit(-1))
    return df


def test_codes_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=24) * (0.02 if i % 3 else 0.5)], i % 4 if i % 7 else None) for i in range(240)]
    # ties: equal vectors, also among the first entries; vectors on a coarse grid, halfway between entries
    rows[3] = (3, rows[2][1], 1)
    rows += [(300 + i, [float(x) / 4096 for x in rng.integers(-3, 4, 24)], 2) for i in range(120)]
    rows += [(5, rows[9][1], 1), (5, rows[9][1], 1), (None, rows[8][1], 3), (900, None, 1), (901, [None] + [0.0] * 23, 1),
             (902, [float("nan")] * 24, 1), (903, [float("inf")] + [0.0] * 23, None), (904, [0.0] * 24, 1), (905, [], 0), (906, [0.25] * 5, 0)]
    got = rows_of(ball_codes.code_digest(vector_frame(spark, rows)), "vec_id", "code", "error", "label_error", "codebooks_sha256")
    assert got == plain_codes(rows)


def test_codes_of_few_large_and_no_vectors(spark):
    few = [(i, [i / 7] * 8, None) for i in range(5)]
    assert rows_of(ball_codes.code_digest(vector_frame(spark, few))) == plain_codes(few)
    wide = [(i, [float(2 ** (i % 20)) * (-1) ** i] * 16, i % 2) for i in range(40)]  # whole numbers past 2^31: no float is exact
    assert rows_of(ball_codes.code_digest(vector_frame(spark, wide))) == plain_codes(wide)
    assert ball_codes.code_digest(vector_frame(spark, [])).count() == 0
    huge = vector_frame(spark, [(i, [3e38] * 8 if i % 2 else [-3e38] * 8, 1) for i in range(20)])
    assert ball_codes.code_digest(huge).count() == 20


def test_balls_spare_comparisons(spark):
    """Far-apart balls: after the first rounds a part meets its own entry and hardly another."""
    rng = np.random.default_rng(6)
    rows = [(i, (rng.normal(size=16) * 0.01 + (i % 16) * 3.0).astype(np.float32).astype(float).tolist(), 0) for i in range(800)]
    codes = ball_codes.compress(vector_frame(spark, rows))
    assert codes.computed[-1] < 1.1 * 800 * 8 and codes.computed[0] > 2 * 800 * 8
    assert rows_of(codes.rows.select("vec_id", "code", "error")) == [(r[0], r[1], r[2]) for r in plain_codes(rows)]


def test_reassign_equals_all_distances():
    rng = np.random.default_rng(8)
    for kind in range(60):
        parts, entries = rng.integers(-6, 7, (200, 3)) << (kind % 3 * 20), rng.integers(-6, 7, (9, 3)) << (kind % 3 * 20)
        best, distance, _ = ball_codes.reassign(parts, entries, rng.integers(0, 9, 200))
        every = ((parts[:, None].astype(object) - entries[None].astype(object)) ** 2).sum(axis=2)
        want = [min((int(d), j) for j, d in enumerate(row)) for row in every]
        assert [(int(d), int(j)) for d, j in zip(distance, best)] == want


# --- prefix trie -----------------------------------------------------------------------------

def plain_trie(sequences):
    """``sequences``: conversation → list of (role, text)."""
    members = {}
    for conv, said in sequences.items():
        for d in range(len(said) + 1):
            members.setdefault(tuple(said[:d]), []).append(conv)
    children = {node: [other for other in members if len(other) == len(node) + 1 and other[:-1] == node] for node in members}
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[c] for c in children[node]) or 1
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        saved[node] = own + sum(saved[c] for c in children[node])
    out = []
    for node, convs in members.items():
        ends = ",".join(map(str, sorted(c for c in convs if len(sequences[c]) == len(node))))
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children[node]), leaves[node],
                    saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def plain_rebuilt(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(said)] for c, said in own.items()}
    head = lambda c: zlib.crc32(str(c).encode()) % 9
    return {c: own.get(c - c % 5, [])[:head(c)] + said[head(c):] for c, said in own.items()}


def talk(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for name in ("near", "path", "sizes", "range", "kind", "skeleton", "depth", "turns", "one", "h"):
        df = df.withColumn(name, F.lit("x"))
    return df


def test_trie_of_rebuilt_conversations_equals_brute_force(spark):
    rng = random.Random(2)
    rows = []
    for conv in range(400):
        if conv % 35 == 0:
            continue  # absent beginnings
        same = conv % 3 == 0  # a third of all conversations say the same
        for turn in range(6 if same else rng.randint(1, 12)):
            text = f"line {turn}" if same else f"é{rng.randrange(3)}"
            rows.append((conv, turn if turn or conv % 2 else None, rng.choice(("user", "assistant", None)) if not same else "user",
                         None if text == "é0" else text))
    rows += rows[5:9]  # repeated rows are turns of their own
    rows += [(None, 1, "user", "nobody's"), (1000, None, None, None), (1003, 0, "", "x" * 100_000), (10 ** 12, 3, "user", "late")]
    got = prefix_trie.trie(prefix_trie.rebuilt(talk(spark, rows)))
    assert got.columns == prefix_trie.COLUMNS
    assert rows_of(got) == plain_trie(plain_rebuilt(rows))


@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_ranges_do_not_change_the_trie(spark, ranges):
    rng = random.Random(ranges)
    said = {c: [("user", rng.choice("ab") * (i + 1)) for i in range(rng.choice((0, 2, 9, 30)))] for c in range(150)}
    said |= {c: [("user", "again")] * 20 for c in range(200, 320)}  # one path over many ranges
    rows = [(c, i, r, t) for c, one in said.items() for i, (r, t) in enumerate(one)]
    sequences = prefix_trie.paths(prefix_trie.turns(talk(spark, rows)).select("conv_id", "turns"))
    whole = {c: one for c, one in said.items() if one}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    try:
        assert rows_of(prefix_trie.trie(sequences)) == plain_trie(whole)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_trie_of_nothing(spark):
    assert prefix_trie.trie(prefix_trie.rebuilt(talk(spark, []))).count() == 0
    turnless = prefix_trie.trie(prefix_trie.rebuilt(talk(spark, [(4, 0, "user", "x")]))).collect()  # h of "4" is over 0, its family absent
    assert plain_trie(plain_rebuilt([(4, 0, "user", "x")])) == sorted((tuple(r) for r in turnless), key=repr)


def test_skeleton_is_what_neighbours_share():
    a, b, c = (bytes([i]) * prefix_trie.WIDTH for i in (1, 2, 3))
    assert prefix_trie.skeleton([(a, a + b + c), (a + b + c + a, b), (c, c)]) == [b"", a, a + b, a + b + c]
    assert prefix_trie.skeleton([(a, c)]) == [b""] == prefix_trie.skeleton([])


# --- prefix BPE ------------------------------------------------------------------------------

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
LETTERS = "aab  \n\t'sltdé中文१२Ᲊ\U0001e4d0 \x1c\x85 'll1234!!#🙂"


@pytest.fixture(scope="module")
def encoder():
    return prefix_bpe.TextEncoder(RANKS, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(encoder):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=encoder.vocabulary.ranks, special_tokens={})


def test_round_trip_equals_the_library(spark, library):
    rng = random.Random(3)
    rows = ODD + [(100 + i, "".join(rng.choice(LETTERS) for _ in range(rng.randint(1, 60))), "r") for i in range(300)]
    docs = frame(spark, rows).withColumn("ids", F.lit("x")).withColumn("decoded", F.lit("y"))
    want = []
    for key, text, _ in rows:
        ids = library.encode_ordinary(text or "")
        packed = np.array(ids, "<u4").tobytes()
        want.append((key, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    got = prefix_bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN)
    assert rows_of(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=repr)
    assert prefix_bpe.round_trip(frame(spark, []), RANKS, public_tokenizers.PATTERN).count() == 0


def test_every_vocabulary_string_and_random_bytes(encoder, library):
    vocabulary = encoder.vocabulary
    for token in vocabulary.tokens[::37]:
        last = []
        vocabulary.extend(token, last)
        assert vocabulary.walk_back(last, len(token)) == [vocabulary.made[token]]
    rng = random.Random(4)
    for _ in range(300):
        data = bytes(rng.choice(b"aabcdeeinrst \xc3\xa9\xd0\xb0") for _ in range(rng.randint(1, 80)))
        assert vocabulary.piece(data) == plain_merges(vocabulary.ranks, data)


def plain_merges(ranks, data):
    if data in ranks:
        return [ranks[data]]
    parts = [bytes([b]) for b in data]
    while True:
        best = min(((ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks), default=None)
        if best is None:
            return [ranks[p] for p in parts]
        parts[best[1]:best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]


def test_vocabularies_with_ties_and_strings_out_of_reach():
    """Small vocabularies in which one merge overlaps itself, and one holds a string that merging never makes."""
    rng = random.Random(5)
    for _ in range(40):
        ranks, letters = {bytes([b]): b for b in range(256)}, [bytes([c]) for c in b"ab"]
        while len(ranks) < 268:
            joined = rng.choice(letters) + rng.choice(letters)
            if joined not in ranks and len(plain_merges(ranks, joined)) == 2:
                ranks[joined] = len(ranks)
                letters.append(joined)
        odd = next(o for o in (bytes(rng.choice(b"ab") for _ in range(9)) for _ in range(999)) if o not in ranks and len(plain_merges(ranks, o)) > 2)
        ranks[odd] = len(ranks)
        vocabulary = prefix_bpe.Vocabulary(ranks)
        for _ in range(60):
            data = bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 14)))
            want = plain_merges(ranks, data)
            if data in vocabulary.made or data not in ranks:
                last = []
                vocabulary.extend(data, last)
                assert len(last) == len(data)
                assert vocabulary.piece(data) == want
            else:
                assert vocabulary.piece(data) == [ranks[data]]


def test_a_vocabulary_needs_all_bytes_first():
    with pytest.raises(ValueError):
        prefix_bpe.Vocabulary({b"a": 0})
    with pytest.raises(ValueError):  # "aab" comes before "ab", from which it is merged
        prefix_bpe.Vocabulary({bytes([b]): b for b in range(256)} | {b"aab": 256, b"ab": 257})


def test_appends_and_edits_equal_encoding_anew(encoder, library):
    rng = random.Random(6)
    for _ in range(80):
        text = "".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 60)))
        edited = prefix_bpe.EditedText(encoder, text)
        for _ in range(6):
            begin = rng.randint(0, len(text))
            end = min(len(text), begin + rng.choice((0, 0, 1, 3, 20)))
            new = "".join(rng.choice(LETTERS) for _ in range(rng.choice((0, 1, 2, 8))))
            text = text[:begin] + new + text[end:]
            edited.replace(begin, end, new)
            assert edited.text == text and edited.ids() == library.encode_ordinary(text)
        text += " and more"
        edited.append(" and more")
        assert edited.ids() == library.encode_ordinary(text)
    long = prefix_bpe.EditedText(encoder, "several words in a row, " * 2000)
    assert long.replace(20_000, 20_003, "XYZ") < 12


def test_prefixes_after_an_edit_are_few(encoder):
    rng = random.Random(7)
    data = bytes(rng.choice(b"aabcdeeinrst ") for _ in range(5000))
    tokens = prefix_bpe.PrefixTokens(encoder.vocabulary, data)
    for upto in (0, 1, 77, 5000):
        assert tokens.ids(upto) == prefix_bpe.PrefixTokens(encoder.vocabulary, data[:upto]).ids()
    computed = tokens.replace(2000, 2003, b"e t")
    assert tokens.last == prefix_bpe.PrefixTokens(encoder.vocabulary, tokens.data).last and computed < 500


def test_unequal_character_classes_go_to_the_library(library):
    """Characters on which the pattern engines disagree send the whole text to the library."""
    own = prefix_bpe.TextEncoder(RANKS, public_tokenizers.PATTERN)
    own.other.add("é")
    texts = ["café 12", None, "", "plain"]
    assert [np.frombuffer(one, "<u4").tolist() for one in own.encode(texts)] == [library.encode_ordinary(t or "") for t in texts]
