"""Fill-in-middle, token counts and the filter audit against brute-force versions and the tokenizer's own library."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict
from itertools import combinations, permutations

import numpy as np
import public_tokenizers
import pytest
import regex
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sparkquill.llm import fill_middle, filter_audit, token_counts

WORD = re.compile("[^\x20\x09-\x0d]+")
ODD = [None, "", " \n\t ", "x", "é", "한국어 text", "a<P>b", "<M>", "<S", "<P", "ends with <", "S>M>", "\U0001f600" * 70, "y" * 513, "é" * 700]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def mixed(seed, n, alphabet="ab é한\U0001f600<PSM>"):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.choice((1, 2, 7, 60, 900)))) for _ in range(n)]


# fill-in-middle


def fim_brute(doc_id, text, seed=1, plain_from=90, spm_below=20):
    text = text or ""
    digest = sha(f"{seed}:{'' if doc_id is None else doc_id}")
    one, two, three, four = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    n = len(text)
    a, b = sorted((one % (n + 1), two % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or three % 100 >= plain_from:
        return n, "plain", None, None, text
    if four % 100 < spm_below:
        return n, "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    return n, "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"


def test_rank_and_select():
    rng = random.Random(4)
    for n in (0, 1, 63, 64, 65, 511, 512, 513, 3000):
        text = "".join(rng.choice("aé한\U0001f600") for _ in range(n))
        data = np.frombuffer(text.encode(), np.uint8)
        starts = [i for i, b in enumerate(data.tolist()) if b & 0xC0 != 0x80]
        held = fill_middle.Boundaries(data)
        places = np.arange(len(data) + 1)
        assert held.rank(places).tolist() == [sum(s < p for s in starts) for p in range(len(data) + 1)] if n < 600 else True
        assert held.directory[-1] == n
        assert held.select(np.arange(n)).tolist() == starts


def test_fill_in_middle(spark):
    rows = list(enumerate(ODD + mixed(1, 300))) + [(None, "no id"), (3, "x"), (3, "x")]
    docs = spark.createDataFrame([(i, t, 7, "s") for i, t in rows], "doc_id long, text string, n int, four string").repartition(3)
    for seed, plain_from, spm_below in ((1, 90, 20), (5, 100, 50)):
        found = fill_middle.transform(docs, seed=seed, plain_from=plain_from, spm_below=spm_below)
        assert found.columns == ["doc_id", "text", "n", "four", "fim"]
        got = found.select("doc_id", "text", "fim.*", fill_middle.restored(F.col("fim.output"), F.col("fim.form")).alias("back"), F.col("n").alias("own")).collect()
        assert Counter((r.doc_id, r.text) for r in got) == Counter(rows)
        for r in got:
            assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == fim_brute(r.doc_id, r.text, seed, plain_from, spm_below)
            assert r.back == (r.text or "")
            assert r.own == 7
        assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_fill_in_middle_of_very_long_and_no_texts(spark):
    long = "한 word " * 400_000
    docs = spark.createDataFrame([(i, long if i == 5 else "short é") for i in range(8)], "doc_id long, text string")
    for r in fill_middle.transform(docs).select("doc_id", "text", "fim.*").collect():
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == fim_brute(r.doc_id, r.text)
    assert fill_middle.transform(docs.limit(0)).count() == 0
    again = docs.withColumn("fim", F.lit("old"))
    assert fill_middle.transform(again).columns == ["doc_id", "text", "fim"]


# token counts


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(token_counts.VOCABULARY))


@pytest.fixture(scope="module")
def counter():
    return token_counts.counter(public_tokenizers.path(token_counts.VOCABULARY))


def by_library(library, texts):
    return [len(e) for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_every_code_point_counts_as_in_the_library(library, counter):
    texts = ["a" + "".join(chr(c) + "b" for c in range(at, at + 4) if not 0xD800 <= c < 0xE000) for at in range(0, 0x30000, 4)]
    assert counter.count(texts).tolist() == by_library(library, texts)


def test_random_texts_count_as_in_the_library(library, counter):
    rng = random.Random(7)
    odd = ["<|startoftext|>", "<|endoftext|>", "<|ENDOFTEXT|>", "'re", "'LL", "ΑΣ", "İ", "é", "é", "ﬁ", "\x1c", "\x85", "　", "٣", "x" * 300, "the quick", "\U0001f600", "՘"]
    texts = ["".join(rng.choice(odd) if rng.random() < 0.2 else rng.choice("abcdefgh THE '0.,-") for _ in range(rng.randint(0, 60))) for _ in range(8000)]
    assert counter.count(texts).tolist() == by_library(library, texts)


def test_parts_of_long_texts_count_as_the_whole(library, counter, monkeypatch):
    monkeypatch.setattr(token_counts, "PART_CHARS", 50)
    texts = [" ".join(t or "" for t in mixed(5, 40)), "x" * 500, "the cat's <|endoftext|> 12 " * 40, "a \u0301 " * 60, " " * 300, "\u3000wide\u3000" * 30]
    assert counter.count(texts).tolist() == by_library(library, texts)
    assert all("".join(token_counts.parts(t, 7)) == t for t in texts)


def test_whole_words_are_proven(library, counter):
    held = sorted(counter.whole)
    assert len(held) > 30_000
    sample = held[::37]
    assert all(len(e) == 1 for e in library.encode_batch(sample, add_special_tokens=False) if len(library.pre_tokenizer.pre_tokenize_str(library.normalizer.normalize_str(e.tokens[0].removesuffix("</w>")))) == 1)
    # one that its merges do not reach must not be called whole
    model = {"vocab": {**{c: i for i, c in enumerate(counter.merges.letter.values())}, **{c + "</w>": 256 + i for i, c in enumerate(counter.merges.letter.values())}, "ab</w>": 600, "cd</w>": 601}, "merges": [["c", "d</w>"]], "end_of_word_suffix": "</w>"}
    found = token_counts.proven_whole(model, token_counts.Merges(model))
    assert "cd" in found and "ab" not in found


def test_token_counts(spark, library):
    texts = ["plain words here", None, "", " \n", "w" * 20_000, "the cat " * 50_000, "<|endoftext|>a", *mixed(2, 60)]
    rows = list(enumerate(texts)) + [(0, texts[0])]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, n_bytes int").repartition(3)
    found = token_counts.counted(docs, into="tokens")
    assert found.columns == ["doc_id", "text", "n_bytes", "tokens"]
    wanted = Counter((i, n) for (i, _), n in zip(rows, by_library(library, [t for _, t in rows]), strict=True))
    assert Counter((r.doc_id, r.tokens) for r in found.collect()) == wanted
    assert token_counts.counted(docs.limit(0)).count() == 0
    assert token_counts.counted(docs, into="n_bytes").columns == ["doc_id", "text", "n_bytes"]


def test_doubtful_characters_are_few():
    assert sum(bool(regex.match(token_counts.DOUBTFUL, chr(c))) for c in range(0x10000) if not 0xD800 <= c < 0xE000) < 200


def test_unknown_vocabularies_are_refused():
    with pytest.raises((ValueError, KeyError, TypeError)):
        token_counts.Counter(public_tokenizers.path("byte_bpe_50k.json"))


# filter audit


def audit_brute(rows, labels):
    """Runs every order step by step."""
    good, toxic = ({i for i, *v in labels if i is not None and v[k] == 1} for k in range(2))
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    fails, parts = [], defaultdict(list)
    for i, t, s in rows:
        t = t or ""
        w = WORD.findall(t)
        held = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search("[#$%&*|]", t)), "E": i is not None and i > least[t]}
        parts[s or ""].append(({f for f, v in held.items() if v}, i in good, i in toxic))
    out = []
    for part, held in parts.items():
        rows_of, shapley = [], Counter()
        for order in permutations("ABCDE"):
            alive = held
            for k, f in enumerate(order):
                gone = [d for d in alive if f in d[0]]
                alive = [d for d in alive if f not in d[0]]
                shapley[f] += len(gone)
                redundant = sum(f in d[0] for d in held) - len(gone)
                rows_of.append((part, "".join(order), k + 1, len(alive), len(gone), redundant, sum(d[0] == {f} for d in held), sum(d[1] for d in gone), sum(d[2] for d in gone)))
        out += [(*r, shapley[r[1][r[2] - 1]]) for r in rows_of]
    return out


def audit_table(seed=9):
    rng = random.Random(seed)
    texts = [None, "", " ", " lead", "trail ", "\n\n", "A", "a #", "word " * 200, "Word " * 250, " ".join(f"w{i}" for i in range(220)), "UPPER " * 199 + "| end", "x " * 30_000]
    texts += [" ".join(rng.choice(("alpha", "Beta", "g#", "d", f"k{rng.randrange(400)}")) for _ in range(rng.choice((3, 150, 199, 200, 201, 260)))) for _ in range(40)]
    rows = [(i, rng.choice(texts), rng.choice(("s1", "s1", "s1", "s2", "", None))) for i in range(160)]
    rows += [rows[3], rows[3], (None, texts[8], "s2"), (None, texts[8], "s2"), (5, "other text of the same id", "s1"), (9, rows[9][1], "s2")]
    labels = [(i, rng.choice((0, 1, None)), rng.choice((0, 1, None))) for i in range(0, 160, 2)] + [(4, 1, 0), (None, 1, 1), (777, 1, 1)]
    return rows, labels


def test_filter_audit(spark):
    rows, labels = audit_table()
    docs = spark.createDataFrame([(*r, "x", True) for r in rows], "doc_id long, text string, source string, part string, A boolean").repartition(5)
    marks = spark.createDataFrame([(*r, 1) for r in labels], "doc_id long, quality int, toxic int, n int")
    joint = filter_audit.joint_failures(filter_audit.flagged(docs, marks), "part", filter_audit.LETTERS)
    found = filter_audit.interactions(joint, "part", filter_audit.LETTERS)
    got = sorted(tuple(r) for r in found.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley").collect())
    assert got == sorted(audit_brute(rows, labels))
    assert len(got) == 600 * 3


def test_filter_audit_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.interactions(filter_audit.joint_failures(filter_audit.flagged(docs, marks), "part", "ABCDE"), "part", "ABCDE").count() == 0


def test_joint_failures_of_other_filters(spark):
    rng = random.Random(2)
    rows = [(rng.choice("pq"), rng.random() < 0.5, rng.random() < 0.3, rng.random() < 0.7, rng.randint(1, 4)) for _ in range(80)]
    df = spark.createDataFrame(rows, "part string, X boolean, Y boolean, Z boolean, n long")
    joint = {r.part: r.n for r in filter_audit.joint_failures(df, "part", "XYZ", ["n"]).collect()}
    for part, sums in joint.items():
        for size in range(4):
            for some in combinations(range(3), size):
                assert sums[sum(1 << k for k in some)] == sum(r[4] for r in rows if r[0] == part and all(r[1 + k] for k in some))
    audit = filter_audit.interactions(filter_audit.joint_failures(df, "part", "XYZ", ["n"]), "part", "XYZ", ["n"]).collect()
    for part in "pq":
        value = {r.filter_order[r.step - 1]: r.shapley for r in audit if r.part == part}
        total = sum(r[4] for r in rows if r[0] == part and any(r[1:4]))
        assert sum(value.values()) == 6 * total
