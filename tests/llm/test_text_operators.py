"""Tokens, languages, quality, licences and chats against plain versions."""

import hashlib
import random
import sys
from pathlib import Path

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from clickstar.llm import chat, language, licences, quality, queries, tokens  # noqa: E402

PIECES = public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id long, text string, n_tokens string, score string, kept string, lang string"


def odd_rows(texts):
    """Texts as rows with clashing extra columns, a null and a repeated id, and a repeated row."""
    rows = [(k, t, "x", "x", "x", None) for k, t in enumerate(texts)]
    rows[-1] = (None, *rows[-1][1:])
    return [*rows, rows[0], rows[0]]


ODD = [
    "",
    None,
    " ",
    "\n\n \t",
    "a",
    "the  the   the\nthe\t▁ the",
    "<s> </s> <0x0A> <unk>",
    "é́ 漢字 😀 \x00  x",
    "x" * 40_000,
    "word " * 9_000,
    "Released under the MIT License.\nword",
    "last",
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(ODD), DOCS)


def test_token_counts_equal_the_library():
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    counts = tokens.WordCounts(tokens.read_ranks(PIECES))
    rng = random.Random(1)
    parts = [*"abcdehinort \n\t\r▁éß漢😀'{}();\x00", "the ", "    ", "<s>", "<0x0A>", " "]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 50)))
        assert tokens.text_tokens(text, counts) == len(model.encode(text)), repr(text)


def test_token_counts_of_odd_rows(odd, spark):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    ranks = tokens.read_ranks(PIECES)
    got = tokens.count_tokens(odd, ranks, limit=4096)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    n = {t: len(model.encode(t or "")) for t in ODD}
    want = [
        (i, len((t or "").encode()), n[t], n[t] > 4096) for i, t, *_ in odd_rows(ODD)
    ]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert tokens.count_tokens(odd.limit(0), ranks, 4096).count() == 0


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = queries.language_model(docs)
    told = language.predict_language(docs, model, ["doc_id", "lang"])
    told = told.withColumn("held_out", queries.held_out()).collect()
    judged = [r for r in told if r["held_out"]]
    assert len(told) == 1000 and len(judged) > 300
    assert sum(r["lang"] == r["lang_pred"] for r in judged) >= 0.97 * len(judged)
    assert sum(r["rejected"] for r in told) <= 0.02 * len(told)
    assert all(0 <= r["score"] <= 1 for r in told)


def test_languages_of_odd_rows(odd, spark):
    rows = [(f"das ist ein Satz {k} und noch einer", "de") for k in range(40)]
    rows += [(f"this is the text {k} of that one", "en") for k in range(40)]
    rows += [(None, "en"), ("lost", None), ("123", "xx")]
    model = language.train_language_model(
        spark.createDataFrame(rows, "text string, lang string"), F.lit(True), id_column="text"
    )
    assert model.languages == ["de", "en"]
    got = language.predict_language(odd, model, ["doc_id", "text", "kept"]).collect()
    assert len(got) == len(ODD) + 2
    for r in got:
        blank = not any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == blank and (not blank or r["score"] == 0)
    assert language.predict_texts(iter(["das ist", "of the text"]), model)[0] == ["de", "en"]
    kept = language.identified(odd, model)
    assert kept.columns == odd.columns
    assert kept.count() == sum(not r["rejected"] for r in got)
    unlearned = language.train_language_model(odd, F.lit(True))
    none = language.predict_language(odd, unlearned, []).collect()
    assert {(r["lang_pred"], r["score"]) for r in none} == {("und", 0.0)}
    assert language.predict_language(odd.limit(0), model, ["doc_id"]).count() == 0


def test_long_texts_are_scored_whole():
    rng = random.Random(3)
    text = " ".join(rng.choice(["das", "the", "ßx", "y1z"]) for _ in range(9_000))
    old, language.BLOCK = language.BLOCK, 1 << 10
    try:
        found, counts = language.text_features(text, 1 << 10)
    finally:
        language.BLOCK = old
    whole, whole_counts = language.text_features(text, 1 << 10)
    assert (found == whole).all() and (counts == whole_counts).all()


def test_quality_measures_and_verdicts(odd, spark):
    rng = random.Random(5)
    texts = list(ODD)
    for _ in range(60):
        some = [rng.choice(["ab", "c#", "<d>", "é", "f|"]) for _ in range(rng.randint(1, 12))]
        parts = [" ".join(some) + rng.choice([" ", "\n", "\n\n", "\t"]) for _ in range(rng.randint(1, 9))]
        texts.append("".join(rng.choice(parts) for _ in range(rng.randint(1, 9))))
    rows = [(k, t, "x", "x", "x", None) for k, t in enumerate(texts)]
    got = quality.quality_verdicts(spark.createDataFrame(rows, DOCS)).collect()
    assert len(got) == len(texts)
    for r in got:
        want = brute.quality(texts[r["doc_id"]])
        assert tuple(r)[1:6] == want, texts[r["doc_id"]]
        failed = want[0] < 20 or 100 * want[4] > 30 * want[0]
        assert r["base_failed"] == failed and not (failed and r["kept"])
    assert quality.quality_verdicts(odd).count() == len(ODD) + 2
    assert quality.quality_verdicts(odd.limit(0)).count() == 0


def test_quality_keeps_prose_and_rejects_junk(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = queries.op3_quality_rules(spark, "/root/testdata/sf0.01").join(labels, "doc_id")
    rows = got.where("not base_failed").collect()
    assert docs.count() == 1000
    good = [r["kept"] for r in rows if r["quality"] == 1]
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.05 * len(bad)


def test_quality_order_does_not_change_verdicts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = quality.with_measures(docs, "doc_id", "text")
    rules = quality.standard_rules()
    names = {r.name for r in quality.ordered_rules(rows, rules)}
    assert names == {r.name for r in rules}
    forth, back = quality.cascade(rules), quality.cascade(rules[::-1])
    assert rows.where(forth != back).count() == 0
    plan = rows.select(forth.alias("kept"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_licence_windows(odd):
    rng = random.Random(1)
    notices = (
        ("A", "the red fox ran over the red hill"),
        ("B", "free use of the red hill is granted"),
        ("C", "ran over"),
    )
    templates = licences.Templates(notices, 0.8)
    vocabulary = "the red fox ran over hill free use of is granted x y".split()
    matched = 0
    for _ in range(3000):
        text = "\n".join(
            " ".join(
                rng.choice(vocabulary) if rng.random() < 0.5 else rng.choice(notices)[1]
                for _ in range(rng.randint(0, 3))
            )
            for _ in range(rng.randint(1, 5))
        )
        lines = [licences.words_of(line) for line in text.split("\n")]
        every = []
        for licence, notice in notices:
            grams = licences.bigrams(licences.words_of(notice))
            for i in range(len(lines)):
                for j in range(i, len(lines)):
                    score = licences.dice(licences.bigrams(sum(lines[i : j + 1], [])), grams)
                    if lines[i] and lines[j] and score >= 0.8:
                        every.append(licences.Match(licence, score, i + 1, j + 1))
        every.sort(key=lambda m: (-m.score, m.first - m.last, m.first, m.licence))
        want = []
        for m in every:
            if all(m.last < k.first or m.first > k.last for k in want):
                want.append(m)
        want.sort(key=lambda m: m.first)
        got = templates.matches(text)
        assert [(m.licence, m.score) for m in got] == [(m.licence, m.score) for m in want], text
        matched += len(got)
    assert matched > 1000
    summary = licences.licence_summary(licences.scan_licences(odd)).collect()
    assert sorted(r["licences"] for r in summary) == [""] * (len(ODD) + 1) + ["MIT"]
    assert licences.scan_licences(odd.limit(0)).count() == 0


def test_licence_notices_within_lines():
    templates = licences.Templates(licences.NOTICES, 0.8)
    mit = next(t for n, t in licences.NOTICES if n == "MIT" and len(t) > 100)
    prose = "some words that say nothing of rights " * 9
    text = f"{prose} Licensed under CC BY 4.0. {prose}\n{prose}{mit}{prose}\nlast"
    assert [(m.licence, m.score, m.first, m.last) for m in templates.notices(text)] == [
        ("CC-BY-4.0", 1.0, 1, 1),
        ("MIT", 1.0, 2, 2),
    ]
    text = f"{prose}Licensed under CC BY 4.0. {prose} Released under the MIT License. {prose}"
    assert [m.licence for m in templates.notices(text)] == ["CC-BY-4.0", "MIT"]
    broken = prose + mit.replace("rights to", "rights\nto") + prose
    assert [(m.licence, m.first, m.last) for m in templates.notices(broken)] == [("MIT", 1, 2)]


def test_near_siblings_of_licences():
    templates = licences.Templates(licences.NOTICES, 0.8)
    for licence, name in (
        ("GPL-2.0", "General Public License, version 2"),
        ("GPL-3.0", "General Public License, version 3"),
        ("LGPL-2.1", "Lesser General Public License, version 2.1"),
        ("LGPL-3.0", "Lesser General Public License, version 3"),
        ("AGPL-3.0", "Affero General Public License, version 3"),
    ):
        line = f"This work is licensed under the GNU {name}."
        for text in (line, f"some prose before it. {line} and after it"):
            assert [m.licence for m in templates.notices(text)] == [licence]
    gpl = next(t for n, t in licences.NOTICES if n == "GPL-3.0" and "redistribute" in t)
    found = templates.notices(gpl.replace("version 3", "version 2"))
    assert [m.licence for m in found] == ["GPL-2.0"]


def test_licence_windows_of_words():
    """Against all windows of words of texts on one line."""
    rng = random.Random(3)
    notices = (("A", "the red fox ran over the red hill"), ("C", "ran over"), ("D", "the red fox sat"))
    templates = licences.Templates(notices, 0.8)
    vocabulary = "the red fox ran over hill sat x".split()
    matched = 0
    for _ in range(1500):
        words = " ".join(
            rng.choice(vocabulary) if rng.random() < 0.6 else rng.choice(notices)[1] for _ in range(8)
        ).split()
        if templates.matches(" ".join(words)):
            continue
        every = []
        for licence, notice in notices:
            grams = licences.bigrams(notice.split())
            for i in range(len(words)):
                for j in range(i + 1, len(words)):
                    inner = licences.bigrams(words[i : j + 1])
                    ends = (words[i], words[i + 1]) in grams and (words[j - 1], words[j]) in grams
                    if ends and licences.dice(inner, grams) >= 0.8:
                        every.append((licence, licences.dice(inner, grams), i, j))
        want = []
        for w in sorted(every, key=lambda w: (-w[1], w[2] - w[3], w[2], w[0])):
            if all(w[3] < k[2] or w[2] > k[3] for k in want):
                want.append(w)
        got = templates.notices(" ".join(words))
        assert sorted((m.licence, m.score) for m in got) == sorted(w[:2] for w in want)
        matched += len(got)
    assert matched > 1000


def test_roles_spelled_like_names_are_read_back(spark):
    roles = ["User", "user", "Assistant", "assistant", "System", "\\User", "Us\\er", "user:", ""]
    rows = [(1, k, role, "x") for k, role in enumerate(roles)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat.chat_digests(chat.chat_segments(turns)).first()
    plain = "".join(f"{role}\nx\n" for role in roles)
    assert got["turns_sha256"] == hashlib.sha256(plain.encode()).hexdigest()
    assert got["loss_chars"] == 1
    shown = [chat.STANDARD.shown(role) for role in roles]
    assert len(set(shown)) == len(roles) and [chat.STANDARD.read(s) for s in shown] == roles


def test_chats_read_back(spark):
    nasty = r"\### Assistant: </turn> ok"
    rows = [(k, t, r, x, "x") for k, t, r, x in (
        [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, 2, "user", "c"), (2, 0, None, None)]
        + [(3, 0, "user", nasty), (3, 1, "assistant", nasty * 3), (4, 0, "sys: </turn>", "é\n### x\\")]
        + [(5, 0, "assistant", "early"), (5, 1, "user", ""), (5, 2, "assistant", "x" * 50_000)]
        + [(None, 7, "user", "no id"), (None, 8, "assistant", "still")]
        + [(6, None, "user", "last"), (6, 0, "user", "twice"), (6, 0, "user", "twice")]
        + [(7, k, ("user", "assistant")[k % 2], f"turn {k}") for k in range(700)]
    )]
    random.Random(2).shuffle(rows)
    turns = spark.createDataFrame(
        rows, "conv_id long, turn long, role string, text string, segment string"
    )
    got = {r["conv_id"]: r for r in chat.chat_digests(chat.chat_segments(turns)).collect()}
    assert len(got) == len({r[0] for r in rows})
    for key, r in got.items():
        own = [x for x in rows if x[0] == key]
        own.sort(key=lambda x: (x[1] is None, x[1] or 0, x[2] or "", x[3] or ""))
        plain = "".join(f"{x[2] or ''}\n{x[3] or ''}\n" for x in own)
        loss = "".join(x[3] or "" for x in own if x[2] == "assistant")
        assert r["n_turns"] == len(own)
        assert r["turns_sha256"] == hashlib.sha256(plain.encode()).hexdigest()
        assert (r["loss_chars"], r["loss_sha256"]) == (
            len(loss),
            hashlib.sha256(loss.encode()).hexdigest(),
        )
    valid = {key for key, r in got.items() if r["valid"]}
    assert valid == {3, None, 7}
    assert chat.chat_digests(chat.chat_segments(turns.limit(0))).count() == 0
    segments = chat.chat_segments(turns.where("conv_id = 3")).collect()
    assert [s["part"] for s in segments] == ["head", "text", "tail"] * 2
    assert [s["loss"] for s in segments] == [False] * 4 + [True, False]
