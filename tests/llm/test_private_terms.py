import hashlib
import random
import re

import pytest

from tickloom.llm import private_terms as pt

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def brute(text):
    out = []
    for kind, p in PLAIN.items():
        for m in re.finditer(p, text or ""):
            d = re.sub(r"[^0-9]", "", m.group())
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m.group().split(".")) if kind == "ip" else 0, "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


TEXTS = [
    None, "", "plain words", "a@b.c", "x a.b_c@d-e.f.g, a@b.com_x@y.com @z.q a@b a@.c", "é😀 1.2.3.4 1.2.3.4.5 256.1.1.1 0255.001.1.1 1.2.3 1.2.3.4.5.6.7.8",
    "4041 8949-7460 8795 4041894974608795 40418949746087951 4 0 4", "+1 (386) 555-3733 +1 2 +123456789012345678 ++49 30 1234567 x+1(2", "4041894974608795+1 (386) 555-3733",
    "9" * 30_000, "a" * 50_000 + "@" + "b" * 10 + ".c", "a." * 20_000, "1.2.3.4 " * 3000, "a@b.c," * 700, "+1-2" * 900, "0 " * 9000,
]


def test_base_spans_match_the_plain_patterns(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "a@b.c"), (3, "a@b.c")]
    spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS spans", "'x' AS row").write.parquet(f"{tmp_path}/documents.parquet")
    got = pt.op1_private_terms(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    for r in got:
        want = brute(TEXTS[r.doc_id] if r.doc_id is not None else "a@b.c")
        assert r.spans == ",".join(want), r.doc_id
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        for k in pt.KINDS:
            assert r[f"n_{k}"] == sum(w.startswith(k) for w in want)


def test_terms_that_reveal(spark):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda omicron sigma upsilon omega".split()
    rows = [(i, " ".join(words[(i * k) % 15] for k in range(1, 12))) for i in range(200)]
    for i in range(4):
        w = words[i], words[i + 5]
        rows.append((1000 + i, f"{w[0]} the quaestor {w[1]} wrote from q.x@mail.example to {w[0]} {w[1]}"))
    rows += [(2000 + k, "copied words hapax near once@mail.example and unicum here") for k in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.id: r for r in pt.sanitise(docs).collect()}
    for i in range(4):
        text, r = rows[200 + i][1], got[1000 + i]
        assert {text[s.start : s.end] for s in r.terms} == {"quaestor", "wrote", "the", "from"}
        assert "quaestor" not in r.text and "[EMAIL]" in r.text and words[i] in r.text
    for k in range(6):  # copies are one text, and tell what one tells
        assert got[2000 + k].text == "[TERM] [TERM] [TERM] [TERM] [EMAIL] [TERM] [TERM] [TERM]" and {t.bits for t in got[2000 + k].terms} == {1.0}
    assert all(got[i].text is None for i in range(200))
    assert pt.sanitise(docs.limit(0)).count() == 0


def common_rows(n=400):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda omicron sigma upsilon omega".split()
    return [(i, " ".join(words[(i * k + i // 15) % 15] for k in range(1, 12))) for i in range(n)]


def marked(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    text = dict(rows)
    return {r.id: {text[r.id][s.start : s.end] for s in r.terms} for r in pt.sanitise(docs).collect() if r.terms}


def test_single_values_and_shared_parts(spark):
    rows = common_rows(400)
    rows += [(1000, "alpha beta hapax gamma one.of@many.example delta")]
    rows += [(1001 + i, f"{w} registrar beta p{i}.q@shared.example gamma") for i, w in enumerate(("alpha", "omega", "theta", "kappa"))]
    assert marked(spark, rows) == {1000: {"hapax"}} | {1001 + i: {"registrar"} for i in range(4)}


def test_copies_count_alike_everywhere(spark):
    rows = common_rows(2000)
    for i, w in enumerate(("alpha", "omega", "theta")):
        rows += [(3000 + 10 * i + c, f"{w} telltale beta same@mail.example gamma") for c in range(10)]
    assert marked(spark, rows) == {3000 + i: {"telltale"} for i in range(30)}


def test_terms_of_the_whole_document(spark):
    rows = common_rows(400)
    far = " ".join(["alpha beta gamma delta"] * 20)
    rows += [(1000, f"Hapax {far} 12 of 345 one.of@many.example 678 or 90, {far} hapax omega HAPAX.")]
    rows += [(1001, f"unicum {far} 10.0.0.1, 10.0.1.2, unicum@value.example, 10.0.2.3 {far}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.id: r for r in pt.sanitise(docs).collect()}
    assert [rows[400][1][s.start : s.end] for s in got[1000].terms] == ["Hapax", "hapax", "HAPAX"]
    assert "hapax" not in got[1000].text.lower() and "[EMAIL]" in got[1000].text
    assert [rows[401][1][s.start : s.end] for s in got[1001].terms] == ["unicum"]
    assert got[1001].text.endswith(f"{far} [IP], [IP], [EMAIL], [IP] {far}")


def planted(n, seed=3):
    """n common documents; values with a word of their own in one to five documents; words that are rare, but fall beside values by chance."""
    rng = random.Random(seed)
    common = [f"common{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(300)]
    rare = ["rare" + "".join(rng.choices("abcdefgh", k=6)) for _ in range(n // 10)]
    rows, want = [], set()
    for i in range(n):
        rows.append((i, " ".join(rng.choices(common, k=20) + rng.sample(rare, 1) * rng.choice([1, 2]))))
    for v in range(40):
        word = "code" + "".join(rng.choices("ijklmnop", k=8))
        for c in range(1 + v % 5):
            at = n + 10 * v + c
            rows.append((at, " ".join([*rng.choices(common, k=9), word, *rng.choices(common, k=3), f"person{v}@host{v}.example", *rng.sample(rare, 1)])))
            want.add((at, word))
    return rows, want


@pytest.mark.parametrize("n", [1000, 8000])
def test_planted_terms_whatever_the_corpus_size(spark, n):
    rows, want = planted(n)
    got = {(i, w.lower()) for i, words in marked(spark, rows).items() for w in words}
    recall, precision = len(got & want) / len(want), len(got & want) / len(got)
    print(f"{n}: recall {recall:.3f}, precision {precision:.3f}")
    assert recall == 1.0 and precision >= 0.97


def test_query_sanitises(spark, tmp_path):
    rows = common_rows(60) + [(1000, "alpha Hapax one.of@many.example"), (1001, None), (1002, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.sanitised_chars, r.sanitised_sha256, r.n_term) for r in pt.op1_private_terms(spark, str(tmp_path)).collect()}
    want = dict(rows) | {1000: "alpha [TERM] [EMAIL]"}
    assert got == {i: (len(t or ""), hashlib.sha256((t or "").encode()).hexdigest(), int(i == 1000)) for i, t in want.items()}
