"""The numpy parts against plain Python."""

import random
import re
import unicodedata

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from creditloom.llm.langid import classify, grams, letter_table
from creditloom.llm.neardup import shingle_sets
from creditloom.llm.packing import cut_lengths
from creditloom.llm.passages import chunks, common_run, common_runs, passage_hashes
from creditloom.llm.rule_ensemble import apply_rules, extract_rules, lasso_logistic, train
from creditloom.llm.stats import count_statistics
from creditloom.llm.token_files import Segment, encode_segment
from creditloom.llm.tokens import TokenCoder, doubtful, doubtful_parts, letter_bytes, vocabulary_path
from creditloom.llm.trees import boost, flatten, sigmoid
from creditloom.llm.words import gathered, line_bounds, slices, span_hashes, utf8, word_bounds

WORD = re.compile("[^\x20\x09-\x0d]+")
ODD = st.lists(st.one_of(st.none(), st.text(alphabet="aAb \n\t\r\vé #|", max_size=40)), max_size=8)


def column(texts):
    return pa.array(texts, pa.string())


@settings(max_examples=150, deadline=None)
@given(ODD)
def test_words_and_lines(texts):
    data, at = utf8(column(texts))
    for bounds, expected in ((word_bounds, WORD.findall), (line_bounds, lambda t: t.split("\n"))):
        starts, ends, of = bounds(data, at)
        for k, text in enumerate(texts):
            got = [bytes(data[starts[i] : ends[i]]).decode() for i in range(of[k], of[k + 1])]
            assert got == expected(text or "")


@settings(max_examples=100, deadline=None)
@given(ODD)
def test_statistics(texts):
    counts = count_statistics(*utf8(column(texts)), 5)
    for k, text in enumerate(t or "" for t in texts):
        words = WORD.findall(text)
        runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        cover = {i + j for i, r in enumerate(runs) if runs.count(r) > 1 for j in range(5)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        got = {c: int(v[k]) for c, v in counts.items()}
        assert got["n_words"] == len(words) and got["word_chars"] == sum(map(len, words)) and got["n_chars"] == len(text)
        assert got["n_symbols"] == sum(c in "#*$%&|<>" for c in text)
        assert got["n_lines"] == len(lines) and got["n_dup_lines"] == len(lines) - len(set(lines))
        assert got["n_repeat_words"] == len(cover)
        assert got["n_distinct_words"] == len({re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in words})
        assert got["n_echo_words"] == sum(a == b for a, b in zip(words, words[1:]))


def test_hashes_do_not_depend_on_place():
    data, at = utf8(column(["one two one", "", "two one"]))
    starts, ends, _ = word_bounds(data, at)
    a, b, c, d, e = span_hashes(data, starts, ends)
    assert a == c == e and b == d and a != b


def test_slices_keep_all_rows_and_long_texts():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * 50, None, "", "b" * 500, "c", "d"]})
    parts = list(slices(batch, "text", 60))
    assert sum((p.column("text").to_pylist() for p in parts), []) == batch.column("text").to_pylist() and len(parts) > 2


@pytest.fixture(scope="module")
def coder():
    return TokenCoder(vocabulary_path(), keep=200)


def test_tokens_equal_the_library(coder):
    draw = random.Random(1)
    parts = ["a", "The", " of", " ", "  ", "\n", "\n\n", "\t", "é", "'s", "12", " x", ".", "\x1c", "\0", "<|endoftext|>", "日本", "\r\n", "!!", " \n", " "]
    texts = [None, "", *("".join(draw.choice(parts) for _ in range(draw.randint(0, 14))) for _ in range(3000)), "word " * 20_000]
    ids, at = coder.encode(column(texts))
    for k, text in enumerate(texts):
        assert ids[at[k] : at[k + 1]].tolist() == coder.tokenizer.encode(text or "", add_special_tokens=False).ids
    ids, at = coder.encode_ending(column(["a", None]), 9)
    assert ids[-1] == 9 and at.tolist() == [0, 2, 3]


def library_ids(coder, text):
    return coder.tokenizer.encode(text or "", add_special_tokens=False).ids


def test_words_are_encoded_once_whatever_mark_follows():
    coder = TokenCoder(vocabulary_path())
    texts = ["Un été, un été. Un été!\n", "un été;"]
    ids, at = coder.encode(column(texts))
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == [library_ids(coder, t) for t in texts]
    assert set(coder.known) == {x.encode() for x in ("Un", " un", " Un", "un", " été", ",", ".", "!\n", ";")}
    seen, learn = [], coder._learn
    coder._learn = lambda parts: (seen.extend(parts.to_pylist()), learn(parts))
    coder.encode(column(["Un été!\n", "été? un été."]))
    assert sorted(seen) == sorted(["été".encode(), b"?"])


def test_letters_beyond_ascii_by_their_bytes(coder):
    texts = [x for k in range(0x80, 0x600) for x in (f"x{chr(k)}!", f" {chr(k)}", f"x{chr(k)}y .{chr(k)}-")]
    ids, at = coder.encode(column(texts))
    for k, text in enumerate(texts):
        assert ids[at[k] : at[k + 1]].tolist() == library_ids(coder, text)
    for k in [*range(0xC0, 0x180), *range(0x400, 0x480)]:
        assert letter_bytes(np.frombuffer(chr(k).encode(), np.uint8)).all() == unicodedata.category(chr(k)).startswith("L")


PIECES = st.sampled_from(["don", "'t", "'", "''s", "'re", "é", "×", "ÿ", "Ж", "ё", "e\u0301", "!", ".\n", ",", " ", "\n", "7", "<|endoftext|>", "<|", "endoftext", "|>", "日"])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(PIECES, max_size=10).map("".join), min_size=1, max_size=12))
def test_cuts_at_marks_change_no_ids(coder, texts):
    ids, at = coder.encode(column([*texts, None, "a<|endoftext|>b"]))
    for k, text in enumerate([*texts, "", "a<|endoftext|>b"]):
        assert ids[at[k] : at[k + 1]].tolist() == library_ids(coder, text)
    assert len(coder.known) <= 200


def test_long_parts_are_not_kept():
    coder = TokenCoder(vocabulary_path(), keep=4)
    for text in ("ab" * 5000 + " a a", " a b c", " d e f a"):
        ids, _ = coder.encode(column([text]))
        assert ids.tolist() == library_ids(coder, text)
    assert b" a" in coder.known and max(map(len, coder.known)) < 100 and len(coder.known) == len(coder.codes) == len(coder.uses) <= 4


def test_batches_are_put_together_in_order():
    batches = [pa.RecordBatch.from_pydict({"n": [3 * k, 3 * k + 1, 3 * k + 2], "text": ["a" * k, None, "b" * 40]}) for k in range(50)]
    parts = list(gathered(iter([*batches[:20], batches[0].slice(0, 0), *batches[20:]]), "text", 1000))
    assert sum((p.column("n").to_pylist() for p in parts), []) == list(range(150)) and 5 < len(parts) < 20
    assert list(gathered(iter([]), "text", 1000)) == []


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 1200), st.sampled_from([1, 2, 300, 50_000, 2**32]), st.integers(0, 2**31), st.booleans())
def test_segment_round_trip(n, top, seed, outlier):
    draw = np.random.default_rng(seed)
    ids = draw.integers(0, top, n, dtype=np.uint64).astype(np.uint32)
    if outlier and n:
        ids[draw.integers(0, n)] = 2**32 - 1
    ends = np.sort(np.append(draw.integers(0, n + 1, 3), n))
    segment = Segment(encode_segment(ids, ends))
    assert (segment.ids() == ids).all()
    for k, end in enumerate(ends):
        assert (segment.document(k) == ids[ends[k - 1] if k else 0 : end]).all()


def test_segment_packs_outliers_apart():
    ids = np.full(2560, 7, np.uint32)
    ids[::256] = 1_000_000
    assert len(encode_segment(ids, np.asarray([2560]))) < 300
    with pytest.raises(ValueError):
        Segment(b"none" + bytes(40))


@pytest.mark.parametrize("total", [0, 1, 64, 65, 683, 1025, 2047, 2048, 2049, 4096 + 1500])
def test_pieces_of_a_document(total):
    out = cut_lengths(total, 2048, 64)
    assert sum(out) == total and all(x <= 64 or x == 2048 // (2048 // x) for x in out) and len(out) <= total // 2048 + 6


def test_shingle_sets():
    sets, at = shingle_sets(*utf8(column(["A b c d e", "a B c d", "a b", "a b", "", None, "a a a a a a"])), 4)
    assert np.diff(at).tolist() == [2, 1, 1, 1, 0, 0, 1]
    assert sets[at[1]] in sets[at[0] : at[1]] and sets[at[2]] == sets[at[3]]


def test_language_grams():
    letters = letter_table()
    ids, at = grams(["ab", "AB", "a1b", "", "12 3", "日"], letters, 12)
    assert ids[at[0] : at[1]].tolist() == ids[at[1] : at[2]].tolist()
    assert np.diff(at)[3] == np.diff(at)[4] == 0 and np.diff(at)[5] > 0
    best, _, score = classify(ids, at, np.zeros((1 << 12, 0)))
    assert best.tolist() == [0] * 6 and score.tolist() == [0, 0, 0, 1, 1, 0]


def test_chunks_resist_insertions():
    draw = random.Random(5)
    words = ["".join(draw.choice("abcdefgh") for _ in range(draw.randint(1, 9))) for _ in range(400)]
    moved = ["new", "start", *words[:200], "inserted", *words[200:]]
    digests, sizes, at = chunks(*utf8(column([" ".join(words), " ".join(moved), "", "x"])), 4)
    assert sizes[at[0] : at[1]].sum() == 400 and sizes[at[1] : at[2]].sum() == 403 and np.diff(at)[2:].tolist() == [0, 1]
    left, right = set(digests[at[0] : at[1]].tolist()), set(digests[at[1] : at[2]].tolist())
    assert len(left & right) >= len(left) - 6
    apart, _, alone = chunks(*utf8(column([" ".join(moved)])), 4)
    assert apart.tolist() == digests[at[1] : at[2]].tolist() and len(alone) == 2


@pytest.mark.parametrize("size", [1, 2, 3, 5, 8, 12, 50])
def test_equal_runs_have_a_chunk_in_common(size):
    draw = random.Random(size)
    for letters in ("a", "ab", "abcde") * 10:
        texts = [" ".join(draw.choices(letters, k=draw.randint(0, 4 * size))) for _ in range(5)]
        hashes, found_by, owner = passage_hashes(*utf8(column(texts)), size)
        digests, sizes, at = chunks(*utf8(column(texts)), size)
        assert len(hashes) == sum(max(0, len(t.split()) - size + 1) for t in texts) and sizes.sum() == sum(len(t.split()) for t in texts)
        assert len(set(zip(hashes.tolist(), found_by.tolist()))) == len(set(hashes.tolist()))
        for k in range(len(texts)):
            assert set(found_by[owner == k].tolist()) <= set(digests[at[k] : at[k + 1]].tolist())


def test_common_run():
    assert common_run(list("xabcdy"), list("abcdz"), 2, 1) == (1, 4)
    assert common_run(list("ab"), list("cd"), 0, 0) == (0, 0)
    assert common_run(["a"], [], 0, 0) == (0, 0)
    places = [{"pos": 1, "other_pos": 0}, {"pos": 3, "other_pos": 2}, {"pos": 6, "other_pos": 6}]
    assert common_runs(list("xabcdyq"), list("abcdzzq"), places, 2) == [(1, 4)]
    assert common_runs(list("xabcdyq"), list("abcdzzq"), places, 1) == [(1, 4), (6, 1)]


def test_trees_learn_and_keep_to_directions():
    draw = np.random.default_rng(0)
    x = draw.random((3000, 3))
    y = ((x[:, 0] > 0.5) ^ (draw.random(3000) < 0.1)).astype(float)
    trees, base = boost(x, y, [1, -1, 0], trees=30)
    forest = flatten(trees, 3, base)
    assert np.mean((forest.score(x) > 0.5) == (x[:, 0] > 0.5)) > 0.97
    line = np.repeat(np.linspace(0, 1, 200)[:, None], 3, axis=1)
    for f, sign in ((0, 1), (1, -1)):
        probe = np.full((200, 3), 0.4)
        probe[:, f] = line[:, 0]
        assert (np.diff(forest.margin(probe)) * sign >= -1e-12).all()
    assert flatten(*[boost(x, np.ones(3000), [0, 0, 0])[0]], 3, 1.0).margin(x[:2]).tolist() == [1.0, 1.0]
    assert boost(np.zeros((0, 3)), np.zeros(0), [0] * 3) == ([], 0.0)


def test_forest_against_a_walk_of_its_trees():
    draw = np.random.default_rng(5)
    x = np.round(draw.random((600, 4)), 1)
    trees, base = boost(x, (x[:, 0] + x[:, 2] > draw.random(600) * 2).astype(float), [1, 0, -1, 0], trees=12)

    def leaf(tree, row):
        node = 0
        while tree.feature[node] >= 0:
            node = tree.left[node] if row[tree.feature[node]] <= tree.threshold[node] else tree.right[node]
        return tree.value[node]

    walked = [base + sum(leaf(tree, row) for tree in trees) for row in x]
    assert flatten(trees, 3, base).margin(x) == pytest.approx(walked, rel=1e-12)


def test_compiled_rules_equal_the_matrix(spark):
    draw = np.random.default_rng(6)
    x = np.round(draw.random((400, 3)), 1)
    y = ((x[:, 0] > 0.3) & (x[:, 1] <= 0.6)).astype(float)
    model = train(x, y, ["a", "b", "c"], trees=10)
    assert len(model.rules) > 1
    frame = spark.createDataFrame([(k, *map(float, row)) for k, row in enumerate(x)], "k int, a double, b double, c double")
    got = [r.score for r in frame.withColumn("score", model.column()).orderBy("k").collect()]
    expected = sigmoid(apply_rules(x, model.rules) @ np.asarray(model.weights) + model.intercept)
    assert got == pytest.approx(expected.tolist(), rel=1e-12)


@given(st.lists(st.text(" \n\t\x1c\u00a0\u2003éa1", min_size=1, max_size=5), min_size=1, max_size=30))
def test_doubtful_parts(parts):
    raw = [p.encode() for p in parts]
    at = np.cumsum([0, *map(len, raw)])
    assert doubtful_parts(np.frombuffer(b"".join(raw), np.uint8), at).tolist() == [doubtful(p) for p in raw]


def test_rules_are_the_paths_of_trees():
    draw = np.random.default_rng(1)
    x = draw.random((2000, 2))
    y = ((x[:, 0] > 0.3) & (x[:, 1] < 0.6)).astype(float)
    trees, _ = boost(x, y, [0, 0], trees=10, depth=2)
    rules = extract_rules(trees)
    z = apply_rules(x, rules)
    assert len(rules) == len(set(rules)) and z.shape == (2000, len(rules))
    w, b = lasso_logistic(z, y, 0.002)
    assert np.mean(((z @ w + b) > 0) == (y > 0)) > 0.97 and (np.abs(w) > 1e-9).sum() < len(rules)
    w, _ = lasso_logistic(z, y, 10.0)
    assert (w == 0).all()
