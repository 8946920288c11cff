"""The prefix trie against a model that rebuilds and walks every conversation, and against its SQL."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import pytest

from tickloom.llm import prefix_trie

DATA = Path("/root/testdata/sf0.001")
KINDS = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            convs[c].append(((turn is not None, turn or 0, sha(f"{len(role.encode())}:{role}{text}")), (role, text)))
    convs = {c: [x for _, x in sorted(v)] for c, v in convs.items()}
    whole = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        whole[c] = tuple(convs.get(c - c % 5, [])[:h] + own[h:]) if c >= 0 else None
    members, ends = defaultdict(list), defaultdict(list)
    for c, seq in whole.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
        ends[seq].append(c)
    kids = Counter(n[:-1] for n in members if n)
    leaves, saved = Counter(), Counter()
    for n, m in members.items():
        gain = (len(m) - 1) * len(n[-1][1].encode()) if n else 0
        for d in range(len(n) + 1):
            saved[n[:d]] += gain
            leaves[n[:d]] += not kids[n]
    return sorted(
        (min(m), len(n), min(members[n[:-1]]) if n else -1, len(m), kids[n], leaves[n], saved[n], sha(",".join(map(str, sorted(ends.get(n, [])))))) for n, m in members.items()
    )


def found(df):
    assert df.columns == COLUMNS
    return sorted(tuple(-1 if v is None else v for v in r) for r in df.collect())


def test_random_tries(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 3)
    monkeypatch.setattr(prefix_trie, "LIST", 4)
    rng = random.Random(5)
    rows = []
    for c in rng.sample(range(90), 70):
        start = rng.choice([[], ["a"], ["a", "b"], ["a", "b", "c", "d"] * 4])
        for turn, text in enumerate(start + [rng.choice("ab") for _ in range(rng.randrange(6))]):
            rows.append((c, turn, rng.choice(["user", "user", None]), rng.choice([text, text, text, "é" + text, None])))
    rng.shuffle(rows)
    assert found(prefix_trie.trie(spark.createDataFrame(rows, KINDS).repartition(5))) == brute(rows)


def test_copies_ties_nulls_and_clashing_columns(spark):
    rows = [(c, t, "user", "same") for c in range(40) for t in (None, 0, 1)]  # copies, with a null turn first
    rows += [(50, 7, r, x) for r, x in (("a", "bc"), ("ab", "c"), ("ab", "c"), (None, None))]  # ties and repeats
    rows += [(61, 0, "user", "only"), (None, 0, "user", "nobody's"), (72, None, None, "")]
    want = brute(rows)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], KINDS + ", depth long, digest string")
    assert found(prefix_trie.trie(df)) == want
    root = want[0] if want[0][1] == 0 else next(r for r in want if r[1] == 0)
    assert root[3] == 43


def test_roles_and_texts_are_not_run_together(spark):
    rows = [(5, 0, "a", "bc"), (10, 0, "ab", "c"), (15, 0, "", "abc")]
    assert len(found(prefix_trie.trie(spark.createDataFrame(rows, KINDS)))) == 4


def test_long_conversation_and_text(spark):
    rows = [(5, t, "user", f"t{t}") for t in range(5000)] + [(10, t, "user", f"t{t}") for t in range(4990)] + [(15, 0, "user", "x" * 3_000_000)]
    got = {(r[0], r[1]): r for r in found(prefix_trie.trie(spark.createDataFrame(rows, KINDS)))}
    assert len(got) == 5002 and got[5, 4990][3:6] == (2, 1, 1) and got[5, 4991][3] == 1
    bytes_ = [len(f"t{t}") for t in range(4990)]
    assert got[5, 0][6] == sum(bytes_) and got[5, 100][6] == sum(bytes_[99:]) and got[5, 4991][6] == 0
    assert got[5, 4990][7] == sha("10") and got[5, 5000][7] == sha("5")


def test_empty_table(spark):
    assert found(prefix_trie.trie(spark.createDataFrame([], KINDS))) == []


@pytest.mark.skipif(not DATA.exists(), reason="needs the driver's tables")
def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = found(prefix_trie.op11_prefix_trie(spark, str(DATA)))
    assert got == brute(rows)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{DATA}/conversations.parquet'")
    cur = con.execute(prefix_trie.ORACLE)
    assert [d[0] for d in cur.description] == COLUMNS
    assert sorted(tuple(-1 if v is None else v for v in r) for r in cur.fetchall()) == got
