"""Learned operators against plain re-computation, planted cases and depleted documents."""

import math
import os
import random
import zlib
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import pytest

from basketry.llm import language_id, line_quality, pii_spans
from basketry.llm.textual import mixed

TABLES = "/root/testdata/sf0.001"


@cache
def bucket(gram):
    code = len(gram)
    for c in gram:
        code = (code * 0x110001 + ord(c)) % 2**64
    return int(mixed(np.array([code], np.uint64))[0]) % language_id.BUCKETS


def grams(text):
    for size in language_id.SIZES:
        for p in range(len(text) - size + 1):
            gram = text[p : p + size]
            if any("a" <= c <= "z" or ord(c) >= 0xAA for c in gram):
                yield bucket(gram)


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="no given tables")
def test_language_id_agrees_with_plain_counting(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    rows = [r for r in docs.select("doc_id", "text", "lang").collect() if r["doc_id"] is not None]
    held = {r["doc_id"]: zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in rows}
    counts, n_rows = defaultdict(Counter), Counter()
    for r in rows:
        if not held[r["doc_id"]] and r["lang"] is not None and r["text"] is not None:
            n_rows[r["lang"]] += 1
            counts[r["lang"]].update(grams(r["text"].lower()))
    langs = sorted(counts)
    total = {k: sum(counts[k].values()) + language_id.SMOOTHING * language_id.BUCKETS for k in langs}
    got = {r["doc_id"]: r for r in language_id.report(docs).collect()}
    right = []
    for r in rows:
        of, found = list(grams((r["text"] or "").lower())), got[r["doc_id"]]
        assert found["held_out"] == held[r["doc_id"]]
        if not any(c.isalpha() for c in r["text"] or ""):
            assert found["lang_pred"] == "und"
            continue
        mean = {k: sum(math.log((counts[k][g] + language_id.SMOOTHING) / total[k]) for g in of) / max(len(of), 1) for k in langs}
        logit = {k: min(len(of), language_id.EVIDENCE) * mean[k] + math.log(n_rows[k] / sum(n_rows.values())) for k in langs}
        weight = {k: math.exp(logit[k] - max(logit.values())) for k in langs}
        assert found["lang_pred"] == max(langs, key=weight.get)
        assert found["score"] == pytest.approx(max(weight.values()) / sum(weight.values()), abs=1e-3)
        if held[r["doc_id"]] and r["lang"] is not None:
            right.append(found["lang_pred"] == r["lang"])
    assert len(right) > 20 and sum(right) >= 0.95 * len(right)
    # Languages in blocks of one give the same answers.
    for r in language_id.report(docs, block_langs=1).collect():
        if r["doc_id"] is not None:
            assert r["lang_pred"] == got[r["doc_id"]]["lang_pred"]
            assert r["score"] == pytest.approx(got[r["doc_id"]]["score"], abs=1e-6)


def secrets(rng):
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    draw = lambda n: "".join(rng.choice(letters) for _ in range(n))
    yield "key", "AKIA" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(15)) + "7"
    yield "token", "ghp_" + draw(35) + "4"
    yield "password", draw(5) + "7x" + draw(5) + "9"


def test_planted_secrets_are_found_and_plain_numbers_left_alone(spark):
    rng, docs, planted = random.Random(5), [], {}
    plain = "the library opens early and many people read there until noon".split()
    for i in range(300):
        words = [rng.choice(plain) for _ in range(60)]
        if i % 3 == 0:
            cue, secret = list(secrets(rng))[i // 3 % 3]
            words[20:20] = [cue, secret]
            planted[i] = secret
        elif i % 3 == 1:
            words[20:20] = ["see", rng.choice(("section", "chapter", "page", "version")), f"{rng.randint(1, 99)}.{rng.randint(100, 999)}.{rng.randint(1, 9)}"]
        docs.append((i, " ".join(words)))
    found = {r["doc_id"]: r["spans"] for r in pii_spans.report(spark.createDataFrame(docs, "doc_id long, text string")).collect()}

    def hit(i):
        begin = docs[i][1].index(planted[i])
        return any(int(a) <= begin and begin + len(planted[i]) <= int(b) for _, a, b in (s.split(":") for s in found[i].split(",") if s))

    assert sum(map(hit, planted)) >= 0.9 * len(planted)
    assert sum(bool(s) for i, s in found.items() if i not in planted) <= 10


def test_depleted_documents_are_rejected(spark):
    def body(i, n):
        return " ".join(f"w{i}x{j}" for j in range(n))

    notice = " ".join(f"notice{j}" for j in range(40))
    docs = [(i, body(i, 70), "host") for i in range(100)]
    docs += [(200 + i, f"{body(200 + i, 70)}\n{notice}", "host") for i in range(14)]
    docs += [(300, f"{notice}\n{body(300, 30)}", "host"), (301, f"{notice}\n{body(301, 40)}", "host"), (400, f"{notice}\n{body(400, 30)}", "other"), (401, body(401, 49), "host")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string")
    got = {r["doc_id"]: r for r in line_quality.report(frame).collect()}
    # Only document 300 is left with less than half of its words; the line is not frequent on the other host.
    assert {i for i, r in got.items() if not r["kept"]} == {300, 401}
    assert not got[300]["base_failed"] and got[401]["base_failed"]
    assert {i for i, r in got.items() if r["n_cut_words"]} == {200 + i for i in range(14)} | {300, 301}
    left = {r["doc_id"]: r["text"] for r in line_quality.clean(frame).collect()}
    assert left[400] == docs[-2][1] and left[301] == body(301, 40) and left[205] == body(205, 70) and 300 not in left


def test_an_absolute_limit_depletes_documents_of_a_large_host(spark):
    def body(i, n):
        return " ".join(f"w{i}x{j}" for j in range(n))

    # The notice is in 20 of 400 documents of the host, far below a tenth; each has a text of its own.
    notice = " ".join(f"notice{j}" for j in range(40))
    docs = [(i, body(i, 60), "host") for i in range(380)] + [(500 + i, f"{notice}\n{body(500 + i, 30 if i % 2 else 45)}", "host") for i in range(20)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string")
    rejected = lambda **limits: {r["doc_id"] for r in line_quality.report(frame, **limits).collect() if not r["kept"]}
    assert rejected() == rejected(max_docs=20) == set()
    assert rejected(max_docs=19) == {500 + i for i in range(1, 20, 2)}
    left = {r["doc_id"]: r["text"] for r in line_quality.clean(frame, max_docs=19).collect()}
    assert left[500] == body(500, 45) and 501 not in left and left[7] == body(7, 60)
