import hashlib
import random
import re
from collections import defaultdict

import pytest

from cases import no_docs, odd_docs, ordered, pairs, some_docs
from postloom.llm import personal
from postloom.llm.personal import KINDS, personal_data, written
from postloom.llm.queries import QUERIES

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(text):
    return re.sub("[^0-9]", "", text)


def luhn(number):
    doubled = [sum(divmod(2 * int(d), 10)) if i % 2 else int(d) for i, d in enumerate(reversed(number))]
    return sum(doubled) % 10 == 0


def plain_base(text):
    """(kind, start, end) by the contract's patterns, in code points."""
    out = [(0, *m.span()) for m in EMAIL.finditer(text)]
    out += [(1, *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(2, *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    return out + [(3, *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15]


def in_bytes(text, spans):
    size = lambda i: len(text[:i].encode())
    return [(k, size(s), size(e)) for k, s, e in spans]


def plain_personal(docs):
    """(found spans per text, accepted patterns) with words and values as they are, all counts in plain loops."""
    texts = [t or "" for _, t in docs]
    bases = [plain_base(t) for t in texts]
    spans, totals = [], defaultdict(int)
    for number, (text, base) in enumerate(zip(texts, bases)):
        low = text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        places = [m.span() for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)]
        w = ["0" if re.search("[0-9]", low[s:e]) else low[s:e] for s, e in places]
        for k in personal.SIZES:
            for i in range(len(w) - k + 1):
                totals[tuple(w[i : i + k])] += 1
        raw = text.encode()
        loose = [(s, e, kinds) for s, e, kinds in personal.candidates(raw, in_bytes(text, base))]
        loose = [(len(raw[:s].decode()), len(raw[:e].decode()), kinds) for s, e, kinds in loose]
        for kind, s, e, kinds in [(k, s, e, 1 << k) for k, s, e in base] + [(-1, s, e, kinds) for s, e, kinds in loose]:
            before, after = [x for x, (_, b) in zip(w, places) if b <= s], [x for x, (a, _) in zip(w, places) if a >= e]
            patterns = [("left", *before[-k:]) for k in personal.SIZES if len(before) >= k] + [("right", *after[:k]) for k in personal.SIZES if len(after) >= k]
            part = text[s:e]
            value = part.lower() if re.search(r"[A-Za-z@:\x80-\U0010ffff]", part) else digits(part)
            spans.append((number, kind, s, e, kinds, value, patterns))
    seeds = {(v, k) for _, k, _, _, _, v, _ in spans if k >= 0}
    seed_values = {v for v, _ in seeds}
    edges, shapes = defaultdict(int), defaultdict(int)
    for *_, kinds, value, patterns in spans:
        for p in patterns:
            edges[p, value] += 1
            shapes[p, value] |= kinds
    per_pattern = defaultdict(list)
    for p, v in edges:
        per_pattern[p].append(v)
    scores = {key: 1.0 for key in seeds}
    for _ in range(personal.ROUNDS):
        accepted = {}
        for p, values in per_pattern.items():
            for kind in range(len(KINDS)):
                held = [(v, scores[v, kind]) for v in values if (v, kind) in scores]
                if len(values) >= personal.SUPPORT and sum(x >= personal.LEAST for _, x in held) >= personal.SUPPORT:
                    unknown = sum(edges[p, v] * (1 - scores.get((v, kind), 0)) for v in values if v not in seed_values and shapes[p, v] >> kind & 1)
                    confidence = min(1.0, round(sum(edges[p, v] * x for v, x in held) / (totals[p[1:]] - personal.OPEN * unknown), 6))
                    if confidence >= personal.LEAST:
                        accepted[p, kind] = confidence
        sides = defaultdict(float)
        for (p, kind), confidence in accepted.items():
            for v in per_pattern[p]:
                if v not in seed_values and shapes[p, v] >> kind & 1:
                    sides[v, kind, p[0]] = max(sides[v, kind, p[0]], confidence)
        scores = {key: 1.0 for key in seeds}
        for v, kind, _ in list(sides):
            scores[v, kind] = round(1 - (1 - sides[v, kind, "left"]) * (1 - sides[v, kind, "right"]), 6)
    found = [[] for _ in texts]
    for number, own, s, e, kinds, value, patterns in spans:
        if own >= 0:
            continue
        options = [(c, -kind) for (p, kind), c in accepted.items() if p in patterns and kinds >> kind & 1]
        options += [(scores[value, kind], -kind) for kind in range(len(KINDS)) if scores.get((value, kind), 0) >= personal.KNOWN and kinds >> kind & 1]
        if options:
            found[number].append((-max(options)[1], s, e))
    return found, accepted


def as_text(spans):
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


def plain_query(docs):
    found, _ = plain_personal(docs)
    out = []
    for (doc_id, text), extra in zip(docs, found):
        base = plain_base(text or "")
        digest = hashlib.sha256(as_text(base).encode()).hexdigest()
        out.append((doc_id, *[sum(k == i for k, _, _ in base) for i in range(4)], digest, as_text(base + extra)))
    return ordered(out)


def result(documents):
    rows = documents.select("doc_id", "base", "found").collect()
    return ordered((r.doc_id, [tuple(s) for s in r.base], [tuple(s) for s in r.found]) for r in rows)


def test_base_spans_are_those_of_the_patterns():
    rng = random.Random(11)
    parts = ["a", "b.c", "@", "@", ".", "-", "+", " ", "  ", "(", ")", "%", "_", "é", "日", "\n", "4785380592391139", "4111 1111 1111 1111", "12", "0", "255", "256", "1.2.3.4", "+1 (743) 555-3824", "9" * 25, "x@y.z"]
    for _ in range(20_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert personal.base_spans(text.encode()) == in_bytes(text, plain_base(text)), text


def test_long_texts_take_linear_time():
    for text in ("x" * 400_000, "1" * 400_000, "+1 " * 100_000, "a@" * 200_000, "1.2." * 100_000, ":" * 400_000, "5 " * 200_000 + "@"):
        raw = text.encode()
        personal.candidates(raw, personal.base_spans(raw))


CONTEXTS = [
    *[(i, f"some words before. Call me at +1 (743) 555-38{10 + i} tomorrow and {i} more") for i in range(5)],
    *[(10 + i, f"Other text; call me at (743) 555 99{10 + i}, or later") for i in range(4)],
    (20, "we call me at noon"), (21, "Lorem 7435559910 ipsum dolor"), (22, "clean: item 20210304 of 7777777 pieces"),
    *[(30 + i, f"her mail address is user{i}@mail.example.com for now") for i in range(4)],
    (40, "the mail address is jane (at) mail (dot) example for now, ünï"), (41, "ünï mail address is jürgen@exämple.de!"), (42, "the mail address is unknown"),
    *[(50 + i, f"pay with card number 411111111111111{d} today") for i, d in enumerate("1234")], (60, "card number 4785380592391139 and card number 4012888888881881 or card number 5500005555555559"),
    *[(70 + i, f"host 10.0.0.{i} answered from 300.{i}.1.2") for i in range(5)], (80, "host fe80::1:2:3 answered"), (81, "host 2001:db8:0:0:1:0:0:1 answered"),
    # A text copied often supports nothing: its value is one.
    *[(100 + i, "secret code +49 30 1234567 follows the code 8675309") for i in range(30)],
    (None, "call me at 743 555 0000"), (7, None), (7, ""),
]


def context_docs(spark):
    return spark.createDataFrame([(i, t, 1) for i, t in CONTEXTS], "doc_id bigint, text string, kind int").repartition(5)


def test_contexts_find_what_the_patterns_do_not(spark):
    docs = [(i, t) for i, t in CONTEXTS]
    documents, patterns = personal_data(context_docs(spark))
    found, accepted = plain_personal(docs)
    assert result(documents) == ordered((i, sorted(plain_base(t or "")), sorted(f)) for (i, t), f in zip(docs, found))
    assert patterns.count() == len(accepted)
    assert ordered((r.kind, r.confidence) for r in patterns.collect()) == ordered((k, c) for (_, k), c in accepted.items())
    added = {i: f for (i, _), f in zip(docs, found)}
    assert all([k for k, _, _ in added[10 + i]] == [3] for i in range(4))  # numbers without a plus
    assert added[21] == [(3, 6, 16)]  # a number known from elsewhere
    assert [k for k, _, _ in added[40]] == [0] and [k for k, _, _ in added[41]] == [0]
    assert added[22] == [] and added[20] == [] and added[100] == []


@pytest.mark.parametrize("make", [odd_docs, some_docs, no_docs])
def test_query(spark, make, tmp_path):
    docs = make(spark)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op12_personal"](spark, str(tmp_path)).collect()
    assert ordered(map(tuple, got)) == plain_query(pairs(docs))


def test_written(spark):
    row = spark.sql("SELECT array(named_struct('kind', 3, 'start', 1, 'end', 2), named_struct('kind', 0, 'start', 10, 'end', 12), named_struct('kind', 0, 'start', 9, 'end', 10)) AS s")
    assert row.select(written(row["s"])).first()[0] == "email:9:10,email:10:12,phone:1:2"
