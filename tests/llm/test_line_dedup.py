import numpy as np
import pytest

from tickloom.llm import line_dedup as ld


def brute(rows, num=4, den=5):
    """(id, line): removed, links, for every line with a word."""
    at = []
    for i, text in rows:
        for k, raw in enumerate((text or "").split("\n")) if text is not None else ():
            norm = raw.translate(str.maketrans("\t\x0b\x0c\r", "    ")).lower().strip(" ")
            if norm:
                at.append(((i is None, i or 0, k), norm))
    at.sort()
    classes = {}
    for p, norm in at:
        classes.setdefault(norm, p)
    sets = {n: frozenset(w for w in n.split(" ") if w) for n in classes}
    links = {n: [m for m in classes if m != n and len(sets[n] & sets[m]) * den >= len(sets[n] | sets[m]) * num] for n in classes}
    return {p: (p > classes[n] or any(classes[m] < classes[n] for m in links[n]), len(links[n])) for p, n in at}, classes, links


def data(seed):
    rng = np.random.default_rng(seed)
    words = [f"w{int(k)}" for k in rng.zipf(1.3, 4000) % 400]
    base = [[words[i] for i in rng.integers(0, 4000, rng.integers(1, 40))] for _ in range(25)]
    rows = []
    for d in range(60):
        text = []
        for _ in range(rng.integers(0, 7)):
            line = list(base[rng.integers(0, 25)])
            for _ in range(rng.integers(0, 4)):
                line[rng.integers(0, len(line))] = words[rng.integers(0, 4000)]
            text.append(rng.choice(["", " ", "\t"]) + " ".join(line) + rng.choice(["", "\r"]))
        rows.append((int(d), "\n".join(text)))
    return rows + [(100, None), (101, ""), (102, " \n\t\n"), (None, rows[3][1]), (103, "same SAME same\nsame"), (104, "very long " + " ".join(f"x{k}" for k in range(3000)))]


@pytest.mark.parametrize(("rare", "chunk"), [(64, 128), (3, 4), (0, 128)])
def test_every_link_is_found(spark, rare, chunk):
    rows = data(rare)
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS norm", "1 AS first", "2 AS token")
    want, _, _ = brute(rows)
    got = {((r.id is None), r.id or 0, r.line): (r.removed, r.links) for r in ld.dedup_lines(docs, rare=rare, chunk=chunk).collect()}
    assert {p: v for p, v in want.items() if v != (False, 0)} == {p: v for p, v in got.items() if v != (False, 0)}
    assert all(want[p] == v for p, v in got.items())


def test_query_and_cleaned_text(spark, tmp_path):
    rows = data(9)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumnRenamed("doc_id", "doc_id")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    want, classes, links = brute(rows)
    got = {r.doc_id: r for r in ld.op8_line_dedup(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        mine = {p: v for p, v in want.items() if p[:2] == (i is None, i or 0)}
        assert got[i].n_removed == sum(r for r, _ in mine.values()) and got[i].n_links == sum(n for _, n in mine.values())
        assert got[i].n_lines == (len(text.split("\n")) if text is not None else 0)
    again = {r.doc_id: r.text for r in ld.cleaned(docs, ld.dedup_lines(docs)).collect()}
    for i, text in rows:
        kept = None if text is None else "\n".join(x for k, x in enumerate(text.split("\n")) if not want.get((i is None, i or 0, k), (False, 0))[0])
        assert again[i] == kept


def test_a_frequent_token_brings_no_chance_pairs_together(spark, monkeypatch):
    """Lines that share one frequent token alone are told apart by their second ones; near copies and sets of one token are found."""
    seen = []
    of_chunks = ld._of_chunks
    monkeypatch.setattr(ld, "_of_chunks", lambda rows, *rest: seen.append(rows.count()) or of_chunks(rows, *rest))
    w = spark.range(20000).selectExpr("concat('w', id) AS w").selectExpr("w", "shiftrightunsigned(xxhash64(w), 8) AS h").orderBy("h").first().w  # first in every prefix
    rows = [(d, f"{w} a{d} b{d} c{d} d{d} e{d} f{d}\n{w} a{d} b{d} c{d} d{d} e{d} f{d} g{d}") for d in range(40)] + [(90, "lone\nlone lone\nLone lone lone")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(ld, "ranks", lambda classes: bytes([60]) * ld.BUCKETS)
    got = {(r.id, r.line): (r.removed, r.links) for r in ld.dedup_lines(docs, rare=8).collect()}
    want, _, _ = brute(rows)
    assert {(i, k): v for (_, i, k), v in want.items() if v != (False, 0)} == {p: v for p, v in got.items() if v != (False, 0)}
    assert not seen


def test_near_copies_are_compared_in_one_part_by_what_they_change(spark, monkeypatch):
    """A small table's frequent pairs of tokens are compared at once, and no chunk holds whole sets: a chunk's entry grows with what a line changes, not with the line."""
    runs, packed = [], []
    of_chunks, keep = ld._of_chunks, ld.written
    monkeypatch.setattr(ld, "_of_chunks", lambda *a: runs.append(1) or of_chunks(*a))

    def kept(df, name, *codec):
        out = keep(df, name, *codec)
        packed.extend([out] if name == "packed" else [])
        return out

    monkeypatch.setattr(ld, "written", kept)
    base = [f"v{k}" for k in range(60)]
    rows = [(d, " ".join(f"u{d}" if k == d % 60 else w for k, w in enumerate(base)) + (f" t{d}" if d % 3 else "")) for d in range(90)]
    got = {(r.id, r.line): (r.removed, r.links) for r in ld.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), rare=8, chunk=16).collect()}
    want, _, _ = brute(rows)
    assert {(i, k): v for (_, i, k), v in want.items() if v != (False, 0)} == {p: v for p, v in got.items() if v != (False, 0)}
    assert len(runs) == 1 and packed
    sizes = packed[0].selectExpr("explode(members) AS m").selectExpr("max(size(m.lacks) + size(m.adds)) AS s", "max(size(m.before)) AS b").first()
    assert sizes.s <= 6 and sizes.b < 20


def test_pairs_are_verified_without_interpreted_lambdas(spark, monkeypatch):
    """What is done for each pair of sets, chunks included, holds no lambda function, which Spark would interpret; and chunks of a small group aren't copied to several tasks."""
    plans, chunks, keep = [], [], ld.written

    def kept(df, name, *codec):
        if name in {"matched", "packed"}:
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        out = keep(df, name, *codec)
        chunks.extend([out] if name == "packed" else [])
        return out

    monkeypatch.setattr(ld, "written", kept)
    base = [f"v{k}" for k in range(60)]
    rows = [(d, " ".join(f"u{d}" if k == d % 60 else w for k, w in enumerate(base)) + (f" t{d}" if d % 3 else "")) for d in range(90)]
    rows += [(200 + d, f"p{d % 9} q{d % 9} r{d % 9} s{d % 9} t{d % 9} extra{d}") for d in range(30)]
    got = {(r.id, r.line): (r.removed, r.links) for r in ld.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), rare=8, chunk=16).collect()}
    want, _, _ = brute(rows)
    assert {(i, k): v for (_, i, k), v in want.items() if v != (False, 0)} == {p: v for p, v in got.items() if v != (False, 0)}
    assert len(plans) == 3 and not any("lambda" in p for p in plans)
    assert {r.spread for r in chunks[0].select("spread").collect()} == {1}


def _marked(monkeypatch):
    """The tables that are written on the way, by name."""
    made, keep = {}, ld.written

    def kept(df, name, *codec):
        out = keep(df, name, *codec)
        made.setdefault(name, []).append(out)
        return out

    monkeypatch.setattr(ld, "written", kept)
    return made


def _same_as_brute(spark, rows, **more):
    got = {(r.id, r.line): (r.removed, r.links) for r in ld.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), **more).collect()}
    want, _, _ = brute(rows)
    assert {(i, k): v for (_, i, k), v in want.items() if v != (False, 0)} == {p: v for p, v in got.items() if v != (False, 0)}


def test_prefixes_are_read_as_often_for_a_large_table_as_for_a_small_one(spark, monkeypatch):
    """The parts of the tokens, each of which reads all prefixes, don't grow in number with the input."""
    made = _marked(monkeypatch)
    monkeypatch.setattr(ld, "PART", 8)
    rows = data(5)[:60]
    _same_as_brute(spark, rows)
    assert len(made["met"]) == ld.PARTS


def test_sets_of_different_sizes_do_not_meet_in_a_common_token(spark, monkeypatch):
    """A token in many sets of all sizes isn't frequent in any band of sizes, and is joined like a rare one."""
    made = _marked(monkeypatch)
    word = "longest_of_words"
    monkeypatch.setattr(ld, "LONG", 100)
    rows = [(d, " ".join([word, *(f"a{d}_{k}" for k in range(int(4 * 1.1**d)))])) for d in range(40)]
    rows += [(100 + d, " ".join([word, *(f"a{d}_{k}" for k in range(int(4 * 1.1**d))), f"b{d}"])) for d in range(40)]
    _same_as_brute(spark, rows, rare=12)
    assert "hot" not in made
    assert made["pairs"][0].count() <= 60


def test_words_are_counted_where_their_length_does_not_tell_which_are_rare(spark, monkeypatch):
    """Like a log's lines: long words in all of them, and short ones that tell them apart."""
    made, counted, ranks = _marked(monkeypatch), [], ld.ranks
    monkeypatch.setattr(ld, "ranks", lambda classes: counted.append(1) or ranks(classes))
    rows = [(d, " ".join([*(f"constant_word_{k}" for k in range(6)), *(f"v{d}x{k}" for k in range(4))])) for d in range(40)]
    rows += [(100 + d, f"{rows[d][1]} v{d}y") for d in range(0, 40, 3)]
    _same_as_brute(spark, rows, rare=8)
    assert counted and len(made["prefixes"]) == 2 and "hot" not in made
    counted.clear()
    _same_as_brute(spark, data(6)[:60])
    assert not counted


def test_sets_of_different_frequent_tokens_are_not_verified(spark, monkeypatch):
    """A pair that shares one rare token is verified for its frequent tokens only if it may have one in common."""
    made = _marked(monkeypatch)
    word = [f"frequent_word_number_{k}" for k in range(2)]
    rows = [(d, f"{word[d % 2]} rare_word_number_{d // 2} " + " ".join(f"s{d}x{k}" for k in range(8))) for d in range(40)]
    rows += [(100 + d, f"{rows[d][1]} more") for d in range(40)]
    seen = []
    monkeypatch.setattr(ld._Filters, "near", lambda self, x, y: y("n") * self.den >= x("n") * self.num)
    of_pairs = ld._of_pairs
    monkeypatch.setattr(ld, "_of_pairs", lambda pairs, *rest: seen.append(pairs.where("i2 is null").count()) or of_pairs(pairs, *rest))
    _same_as_brute(spark, rows, rare=8)
    assert "hot" in made and seen[0] <= 40


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert ld.dedup_lines(docs).count() == 0
