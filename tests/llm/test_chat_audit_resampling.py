"""Chat formatting, source divergence and importance resampling against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from creditloom.llm.chat import LAYOUTS, Each, Layout, Template, canonical_turns, chat_digests, fingerprint, format_chats, layout_counts, read_turns, table_of
from creditloom.llm.divergence import audit
from creditloom.llm.entries import LLM_QUERIES
from creditloom.llm.resampling import NO_WORD, Zeros, resample, resampled_documents, run_buckets
from creditloom.llm.terms import encoded_terms

from .conftest import DOCS, prose

CHATS = "conv_id bigint, turn bigint, role string, text string, layout string, part int, Text string"

# 11: chat


@given(st.lists(st.tuples(st.text("ab\\<>/turnex\n", max_size=12), st.text("ab\\<>/turnex\n", max_size=40)), max_size=4))
@settings(max_examples=300, deadline=None)
def test_any_text_comes_back(turns):
    template = Template()
    pieces = [template.write(r, t) for r, t in turns]
    assert template.read("".join(p for p, _ in pieces)) == turns
    for (_, text), (piece, at) in zip(turns, pieces, strict=True):
        under = piece[at : len(piece) - len(template.end) - 1]
        assert template.unescape(under) == text and not any(m in under for m in ("<turn>", "<text>", "</turn>"))


def test_templates_that_cannot_be_read_are_refused():
    for marks in [("<a>", "<a>", "</a>"), ("aa", "<b>", "<c>"), ("<\\a", "<b>", "<c>"), ("<", "<b>", "<c>")]:
        with pytest.raises(ValueError):
            Template(*marks)
    with pytest.raises(ValueError):
        Template().read("### no turn")


def digests_of(turns):
    said = "".join(f"{r}\n{t}\n" for r, t in turns)
    loss = "".join(t for r, t in turns if r == "assistant")
    chars = sum(len(Template().write(r, t)[0]) for r, t in turns)
    return (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), chars)


def test_chats_of_odd_rows(spark):
    long = "long \\ <turn> " * 100_000
    rows = [
        (1, 1, "assistant", "b</turn>", "x", 1, "T"), (1, 0, "user", "a\n\\", "x", 1, "T"), (1, 1, "assistant", "b</turn>", "x", 1, "T"), (2, 0, "user", None, None, None, None),
        (3, 0, None, "no role", None, 0, ""), (None, 0, "user", "x", None, 0, ""), (None, 1, "assistant", "", None, 0, ""), (4, None, "user", "first", "", 0, ""), (4, 0, "user", "then", "", 0, ""),
        (5, 0, "assistant", long, "", 0, ""), (6, 3, "<turn>\nassistant", "é\U0001f600", "", 0, ""), *[(7, k, "assistant" if k % 2 else "user", f"turn {k}", "", 0, "") for k in range(2000)], (None, None, None, None, None, None, None),
    ]
    spoken = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        spoken[conv].append(((turn is not None, turn or 0), (role is not None, role or ""), (text is not None, text or "")))
    expected = {c: digests_of([(r, t) for _, (_, r), (_, t) in sorted(v)]) for c, v in spoken.items()}
    for part_chars in (1_000_000, 50):
        formatted = format_chats(canonical_turns(spark.createDataFrame(rows, CHATS).repartition(4)), part_chars=part_chars)
        got = {r.conv_id: tuple(r)[1:] for r in chat_digests(formatted).collect()}
        assert got == expected
    parts = formatted.groupBy("conv_id").agg(F.count("*").alias("n"), F.sum(F.col("last").cast("int")).alias("ends")).collect()
    assert all(r.ends == 1 for r in parts) and max(r.n for r in parts) > 500
    back = [r for r in read_turns(formatted).collect() if r.conv_id == 7]
    assert [r.text for r in sorted(back, key=lambda r: (r.part, r.place))] == [f"turn {k}" for k in range(2000)]
    none = spark.createDataFrame([], CHATS)
    assert chat_digests(format_chats(canonical_turns(none))).collect() == []


RECORDS = [
    ('{"conv_id": 1, "messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": [{"type": "text", "text": "b"}, {"type": "text", "text": "c"}]}]}', "messages", [("user", "a"), ("assistant", "bc")]),
    ('{"messages": []}', "messages", []),
    ('{"messages": [{"role": "user", "content": null}], "extra": {"role": "x"}}', "messages", [("user", None)]),
    ('{"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "r"}], "system": "s"}', "sharegpt", [("system", "s"), ("user", "q"), ("assistant", "r")]),
    ('{"instruction": "do", "input": "this", "output": "done"}', "instruction", [("user", "do\n\nthis"), ("assistant", "done")]),
    ('{"instruction": "do", "input": "", "output": 7, "id": 3}', "instruction", [("user", "do"), ("assistant", "7")]),
    ('{"prompt": "p", "completion": "c"}', "prompt", [("user", "p"), ("assistant", "c")]),
    ('{"prompt": "p", "response": "c", "system": "s"}', "prompt_response", [("system", "s"), ("user", "p"), ("assistant", "c")]),
    ('{"question": "q", "context": "x", "answer": "a"}', "question", [("user", "x\n\nq"), ("assistant", "a")]),
    ('{"prompt": "p", "question": "q"}', None, None),
    ('{"prompt": ["p"]}', None, None),
    ("{}", None, None),
    ("not json", None, None),
    (None, None, None),
]


def test_json_records_by_fingerprint(spark):
    frame = spark.createDataFrame([(k, r[0]) for k, r in enumerate(RECORDS)], "n int, record string")
    rows = [(r.layout, None if r.turns is None else [tuple(t) for t in r.turns]) for r in canonical_turns(frame.coalesce(1), json="record").collect()]
    assert rows == [r[1:] for r in RECORDS]
    formatted = format_chats(canonical_turns(frame, json="record"))
    assert formatted.count() == len(RECORDS) and formatted.filter("layout IS NULL").agg(F.sum("n_turns")).first()[0] == 0
    digests = Counter(tuple(r)[1:] for r in chat_digests(formatted).collect())
    assert digests == Counter(digests_of([(r, t or "") for r, t in turns or []]) for _, _, turns in RECORDS)
    assert sum(r.records for r in layout_counts(frame, "record").collect()) == len(RECORDS)


def test_typed_records_have_the_json_fingerprints(spark):
    kind = "conv_id string, prompt string, completion string, question string, answer string, messages array<struct<role string, content string>>, Prompt string"
    rows = [("a", "p", "c", None, None, None, "?"), ("b", None, None, "q", None, None, None), ("c", None, None, None, None, [("user", "u")], None), ("d", None, None, None, None, None, "?")]
    got = canonical_turns(spark.createDataFrame(rows, kind)).orderBy("conv_id").collect()
    assert [r.layout for r in got] == ["prompt", "question", "messages", None]
    assert [tuple(t) for t in got[2].turns] == [("user", "u")] and got[0].fingerprint == fingerprint(["prompt", "completion"])
    json = spark.createDataFrame([('{"completion": "c", "prompt": "p"}',)], "record string")
    assert canonical_turns(json, json="record").first().fingerprint == got[0].fingerprint


def test_layouts_that_share_a_fingerprint_are_refused():
    assert len(table_of(LAYOUTS)) == sum(len(list(x.variants())) for x in LAYOUTS)
    with pytest.raises(ValueError):
        table_of((*LAYOUTS, Layout("again", ("messages[]", "messages[].role"), (), Each("messages", "role", ("x",)))))


# 12: divergence

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {k: k + 32 for k in range(65, 91)}


def brute_audit(rows, least=3, top=200):
    counts, presence, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        terms = TERM.findall((text or "").translate(LOWER))
        counts[lang, source].update(terms)
        presence[lang].update(set(terms))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in presence[lang].items() if n >= least]
        count = {s: {t: counts[lang, s][t] for t in kept} for s in sources}
        every = {t: sum(count[s][t] for s in sources) for t in kept}
        shares = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept}
        p, q = {s: shares(count[s]) for s in sources}, shares(every)
        differ = lambda a, b: (a - b) ** 2 // b
        for a in sources:
            pairs = [(b, sum(differ(p[a][t], p[b][t]) for t in kept)) for b in sources if b != a]
            terms = [(t, differ(p[a][t], q[t])) for t in kept if count[a][t] and p[a][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, a, part, x, v, k + 1) for k, (x, v) in enumerate(ranked if part == "pair" else ranked[:top])]
    return sorted(out)


def test_audit_of_odd_rows(spark, odd_docs, odd_rows, no_docs):
    rows = sorted(map(tuple, audit(odd_docs).collect()))
    assert rows == brute_audit(odd_rows) and len(rows) > 100
    assert audit(no_docs).collect() == []


def test_audit_is_the_same_for_any_blocks(spark):
    draw = random.Random(4)
    words = [prose(draw, 1) for _ in range(300)]
    rows = [(k, " ".join(draw.choice(words) for _ in range(40)) + " É\x00ÀÉ", "en" if k % 3 else "fr", "hot" if k % 3 == 0 else f"h{k % 37}", 0) for k in range(400)]
    docs, expected = spark.createDataFrame(rows, DOCS), brute_audit(rows, top=7)
    for group_block, term_block in ((16, 4096), (3, 20), (1, 1000)):
        assert sorted(map(tuple, audit(docs, top=7, group_block=group_block, term_block=term_block).collect())) == expected
    plan = audit(docs)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan


# 13: resampling

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def brute_features(text, longest=2):
    words = WORD.findall((text or "").translate(LOWER))
    return words, [" ".join(words[k : k + n]) for n in range(1, longest + 1) for k in range(len(words) - n + 1)]


def brute_resample(rows, target, percent=25, buckets=10_000, least=20):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = (Counter(bucket(f) for text in texts for f in brute_features(text)[1]) for texts in ([r[1] for r in rows], target))
    gain = lambda b: math.floor(1000 * math.log(((t[b] + 1) * (s.total() + buckets)) / ((s[b] + 1) * (t.total() + buckets))))
    out = []
    for doc, text, *_ in rows:
        words, features = brute_features(text)
        weight = sum(gain(bucket(f)) for f in features) // len(features) if features else 0
        h = int(hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append([doc, len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words) >= least])
    able = sorted((r for r in out if r[5]), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for k, r in enumerate(able[: percent * len(able) // 100]):
        r[4] = k + 1
    return [tuple(r[:5]) for r in out]


def test_resampling_of_odd_rows(spark, odd_docs, odd_rows, no_docs):
    target = ["ab cd " * 30, None, "", "abc", "ÀB ab9 \x7f9"]
    frame = spark.createDataFrame([(t,) for t in target], "text string")
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    got = Counter(map(tuple, resample(odd_docs, frame).select(columns).collect()))
    assert got == Counter(brute_resample(odd_rows, target))
    assert resample(no_docs, frame).collect() == [] and resample(no_docs, frame.limit(0)).collect() == []
    bare = Counter(map(tuple, resample(odd_docs, frame.limit(0)).select(columns).collect()))
    assert bare == Counter(brute_resample(odd_rows, []))
    drawn = resampled_documents(odd_docs, frame)
    assert drawn.columns == odd_docs.columns
    assert {r.doc_id for r in drawn.collect()} == {r[0] for r in got if r[4] is not None}


def test_resampling_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    got = LLM_QUERIES["op13_importance_resampling"](spark, sf_dir)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"] and {f.dataType.typeName() for f in got.schema} == {"long"}
    assert Counter(map(tuple, got.collect())) == Counter(brute_resample(rows, target))


@given(st.lists(st.text("aB9 é\n-\x00", max_size=60) | st.none(), max_size=5), st.integers(1, 4))
@settings(max_examples=200, deadline=None)
def test_runs_are_hashed_as_their_bytes(texts, longest):
    codes, at, words = encoded_terms(pa.array(texts, pa.string()), NO_WORD)
    for size, (bucket, runs) in enumerate(run_buckets(codes, at, words, longest, 10_000, Zeros()), 1):
        for k, text in enumerate(texts):
            said = brute_features(text)[0]
            whole = [" ".join(said[i : i + size]) for i in range(len(said) - size + 1)]
            assert bucket[runs[k] : runs[k + 1]].tolist() == [zlib.crc32(w.encode()) % 10_000 for w in whole]


def test_zeros_behind_long_words():
    sizes = np.asarray([0, 1, 2, 255, 256, 1000, 70_001])
    got = Zeros().after(np.full(len(sizes), zlib.crc32(b"abc"), np.uint32), sizes)
    assert [int(x) ^ zlib.crc32(b"z" * n) for x, n in zip(got, sizes.tolist(), strict=True)] == [zlib.crc32(b"abc" + b"z" * n) for n in sizes.tolist()]
