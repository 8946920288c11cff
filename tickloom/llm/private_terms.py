"""Personal data, and the terms that give it away. DataFrame functions only.

Four kinds of personal data are found by pattern. Each value found is a protected entity. A term of a document with it is
weighed by information theory, over the whole corpus: of what the entity is worth, IC(entity) = log2(N / n_e), the term
reveals PMI(term; entity) = log2(n_te*N / (n_t*n_e)) and leaves IC - PMI = log2(n_t / n_te) bits open. Terms that leave at most GENERALISE
bits open are replaced by a placeholder of their kind, those that leave at most REMOVE bits are taken out, at every mention in the
documents that have the entity. One bit means that who reads the term is right about the entity as often as not. N
cancels out, so a threshold means the same in a corpus of any size. Terms are words outside all values.

A value that occurs once has little to count, so the part that it shares with others (a mail domain, a network, a
card's issuer, a block of phone numbers) is an entity too. No pair is left out for being rare, but a coincidence isn't certainty: a pair
seen in k different texts counts with k / (k + 1) of its probability, so one text leaves a bit open at least, four a third of one. The kind alone isn't an
entity, as the placeholder tells it anyway.

n_te, n_e and n_t are documents with both, with the entity and with the term, N all documents; copies count in each of
them alike. In k they don't, so copies of a document say nothing new.

Scale: the patterns run in the scan. Only documents with personal data are written whole, and only one of each group of
copies has its words taken out; what it tells holds for all. As n_te is at most n_e, a term in too many documents leaves more
open, whatever n_te is, so pairs are built of the rare terms only (rarest()), which loses none. The entities of a
text that are in no other have the same documents, and are weighed as one. Document frequencies are pre-aggregated hash
aggregations. Joins are on (entity, term), text or row keys, and are left to adaptive execution, which splits hot keys.

Defined results: null and empty texts have nothing. Null identifiers and repeated rows are treated row by
row. An empty table gives an empty table. Extra columns are ignored. Very long runs of letters or digits are
matched without backtracking.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import own_columns, table, written

# Fixed patterns. Possessive, and anchored to where a run begins, so that each finds just what the plain form finds but in linear time.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
KINDS = list(PATTERNS)

#: Bits that a term leaves open about an entity.
GENERALISE, REMOVE = 1.0, 0.2
TERM = r"\p{L}{3,}+"
#: Matches of a text are numbered in blocks of so many, to add up their places.
STRIDE = 256


def located(text: Column, pattern: str) -> Column:
    """array<struct<start, end, value>> of a pattern's matches, in code points.

    The gaps between matches and the matches themselves alternate, so places are running sums of lengths. Sums
    are taken by blocks, so that a text with many matches doesn't take their square.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    steps = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found, lambda g, m: F.length(g) + F.length(m))
    packed = F.struct(found.alias("found"), gaps.alias("gaps"), steps.alias("steps"))

    def sum_of(a: Column) -> Column:
        return F.aggregate(a, F.lit(0), lambda s, x: s + x)

    def with_blocks(p: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(p.found) - 1) / STRIDE).cast("int")), lambda b: sum_of(F.slice(p.steps, b * STRIDE + 1, F.lit(STRIDE))))
        return F.struct(p.found.alias("found"), p.gaps.alias("gaps"), p.steps.alias("steps"), blocks.alias("blocks"))

    def with_bases(p: Column) -> Column:
        bases = F.transform(p.blocks, lambda _, b: sum_of(F.slice(p.blocks, F.lit(1), b)))
        return F.struct(p.found.alias("found"), p.gaps.alias("gaps"), p.steps.alias("steps"), bases.alias("bases"))

    def spans(p: Column) -> Column:
        def one(value: Column, i: Column) -> Column:
            block = F.floor(i / STRIDE).cast("int")
            end = p.bases[block] + sum_of(F.slice(p.steps, block * STRIDE + 1, i - block * STRIDE + 1))
            return F.struct((end - F.length(value)).cast("long").alias("start"), end.cast("long").alias("end"), value.alias("value"))

        return F.transform(p.found, one)

    def chain(p: Column, *fns) -> Column:
        """Binds each step's value once, by mapping over an array of one."""
        a = F.array(p)
        for f in fns:
            a = F.transform(a, f)
        return a[0]

    kind = "array<struct<start:bigint,end:bigint,value:string>>"
    return F.when(F.size(found) > 0, chain(packed, with_blocks, with_bases, spans)).otherwise(F.array().cast(kind))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Whether 13 to 19 digits pass Luhn's check."""
    d = F.reverse(digits(value))

    def worth(i: Column) -> Column:
        x = F.substring(d, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return F.when(x > 9, x - 9).otherwise(x)

    total = F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), lambda s, i: s + worth(i))
    return F.when(F.length(d).between(13, 19), total % 10 == 0).otherwise(False)


def _holds(kind: str, value: Column) -> Column:
    if kind == "ip":
        bare = lambda p: F.ltrim(p, F.lit("0"))
        return F.forall(F.split(value, r"\."), lambda p: (F.length(bare(p)) < 3) | ((F.length(bare(p)) == 3) & (bare(p) <= "255")))
    if kind == "card":
        return luhn(value)
    if kind == "phone":
        return F.length(digits(value)).between(9, 15)
    return F.lit(True)


def _entity(kind: Column, value: Column) -> Column:
    """The same entity however it is written."""
    return F.concat_ws(":", kind, F.when(kind.isin("card", "phone"), digits(value)).otherwise(F.lower(value)))


def _entities(kind: Column, value: Column) -> Column:
    """The value's own entity, and that of the part it shares with other values."""
    bare = digits(value)
    part = F.when(kind == "email", F.substring_index(F.lower(value), "@", -1)).when(kind == "ip", F.substring_index(value, ".", 3)).when(kind == "card", F.left(bare, F.lit(6))).otherwise(F.left(bare, F.length(bare) - 4))
    return F.array(_entity(kind, value), F.concat_ws("/", kind, part))


def _of_kind(kind: str, found: Column) -> Column:
    named = F.transform(found, lambda s: F.struct(F.lit(kind).alias("kind"), s.start.alias("start"), s.end.alias("end"), s.value.alias("value")))
    return F.filter(named, lambda s: _holds(kind, s.value))


def base_spans(text: Column) -> Column:
    """array<struct<kind, start, end, value>> by kind as listed, then start."""
    need = {"email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+"))}
    parts = []
    for kind, pattern in PATTERNS.items():
        found = _of_kind(kind, located(text, pattern))
        parts.append(F.when(need[kind], found).otherwise(F.array().cast("array<struct<kind:string,start:bigint,end:bigint,value:string>>")) if kind in need else found)
    return F.concat(*parts)


def _written_spans(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Written: row (a key), id, spans, chars and sha256 of the text, and key (the same for copies), text and masked, the text with blanks in place of its values, where there are spans."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = own_columns(docs, id_col, text_col).select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    # Most texts have no match at all; the spans are only built where one kind of character is there that each of them needs.
    found = rows.select("id", F.when(text.rlike("[0-9@]"), base_spans(text)).otherwise(F.array().cast("array<struct<kind:string,start:bigint,end:bigint,value:string>>")).alias("spans"), "text")
    has = F.size("spans") > 0
    return written(found.select(F.monotonically_increasing_id().alias("row"), "id", "spans", F.length(text).cast("long").alias("chars"), F.sha2(text, 256).alias("sha256"), F.when(has, F.md5(F.col("text").cast("binary"))).alias("key"), F.when(has, F.col("text")).alias("text"), F.when(has, _masked(F.col("text"), F.col("spans"))).alias("masked")), "personal")


def _replaced(text: Column, cuts: Column, same_length: bool = False) -> Column:
    """text with cuts (start, end, put) carried out. Where they overlap, the first holds and the text goes on after the end of the last."""

    def kept(acc: Column, upto: Column) -> Column:
        return F.substring(text, acc.at.cast("int") + 1, (upto - acc.at).cast("int"))

    def step(acc: Column, s: Column) -> Column:
        if same_length:  # with blanks for what is cut
            out = F.concat(acc.out, F.when(s.start > acc.at, kept(acc, s.start)).otherwise(""), F.repeat(F.lit(" "), F.greatest(s.end - F.greatest(acc.at, s.start), F.lit(0)).cast("int")))
        else:
            out = F.when(s.start < acc.at, acc.out).otherwise(F.concat(acc.out, kept(acc, s.start), s.put))
        return F.struct(F.greatest(acc.at, s.end).alias("at"), out.alias("out"))

    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))
    return F.aggregate(cuts, start, step, lambda acc: F.concat(acc.out, F.substring(text, acc.at.cast("int") + 1, F.lit(2147483647))))


def _in_order(cuts: Column) -> Column:
    return F.array_sort(cuts, lambda a, b: F.when(a.start != b.start, F.sign(a.start - b.start).cast("int")).otherwise(F.sign(b.end - a.end).cast("int")))


def _masked(text: Column, spans: Column) -> Column:
    """text with blanks in place of its values."""
    return _replaced(text, _in_order(F.transform(spans, lambda s: F.struct(s.start.alias("start"), s.end.alias("end")))), same_length=True)


def _words(text: Column) -> Column:
    """Different words of a text, in small letters; too short ones are still there."""
    return F.array_distinct(F.transform(F.array_distinct(F.split(text, r"[^\p{L}]++")), lambda w: F.when(F.length(w) >= 3, F.lower(w)).otherwise("")))


def rarest(n_e: Column, k_e: Column, most_open: float) -> Column:
    """Documents that a term may at most be in, to leave no more than most_open bits about an entity in n_e documents and k_e texts, with some room for rounding."""
    return n_e * k_e / (k_e + 1.0) * 2.0**most_open * 1.000001


def disclosures(docs: DataFrame, found: DataFrame, text_col: str = "text", most_open: float = GENERALISE) -> DataFrame:
    """Written: (key, telling: map of term to bits) of the terms that leave at most that many bits open about an entity of the text."""
    personal = found.where(F.size("spans") > 0)
    one = personal.groupBy("key").agg(F.min("row").alias("row"), F.count("*").alias("copies"))
    entities = F.array_distinct(F.flatten(F.transform("spans", lambda s: _entities(s.kind, s.value))))
    texts = written(personal.drop("key").join(one, "row").select("key", "copies", entities.alias("entities"), _words(F.col("masked")).alias("terms")), "texts")
    known = texts.select("copies", F.explode("entities").alias("entity")).groupBy("entity").agg(F.sum("copies").alias("n_e"), F.count("*").alias("k_e"))
    known = written(known.withColumn("most", rarest(F.col("n_e"), F.col("k_e"), most_open)), "entities")
    most = known.agg(F.max("most").alias("most")).first().most or 0.0

    words = docs.select(F.explode(_words(F.col(f"`{text_col}`"))).alias("term")).where(F.length("term") >= 3)
    wanted = texts.select(F.explode("terms").alias("term")).distinct()
    seen = words.groupBy("term").agg(F.count("*").alias("n_t")).where(F.col("n_t") <= most).join(wanted, "term")
    rare = texts.select("key", F.explode("terms").alias("term")).join(written(seen, "seen"), "term")
    of = texts.select("key", "copies", F.explode("entities").alias("entity")).join(known, "entity")
    of = of.select("key", "copies", F.when(F.col("k_e") == 1, F.concat(F.lit("="), "key")).otherwise(F.col("entity")).alias("entity"), "n_e", "most").distinct()
    pairs = written(of.join(rare, "key").where(F.col("n_t") <= F.col("most")).select("key", "copies", "entity", "n_e", "term", "n_t"), "pairs")

    weighed = pairs.groupBy("entity", "term", "n_e", "n_t").agg(F.sum("copies").alias("n_te"), F.count("*").alias("k"))
    # IC - PMI, with the pair's probability discounted.
    left = F.log2(F.greatest("n_t", "n_te") * (F.col("k") + 1.0) / (F.col("k") * F.col("n_te")))
    telling = written(weighed.select("entity", "term", left.alias("bits")).where(F.col("bits") <= most_open + 1e-9), "telling")
    # Of several entities of a text, the one that a word tells most about decides.
    best = pairs.select("key", "entity", "term").join(telling, ["entity", "term"]).groupBy("key", "term").agg(F.min("bits").alias("bits"))
    return written(best.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("term", "bits"))).alias("telling")), "told")


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """(id, spans, terms, text, chars, sha256): base spans, term spans with the bits they leave open, the sanitised text (null: unchanged), and its chars and sha256."""
    found = detect(docs, id_col, text_col)
    told = disclosures(docs, found, text_col, generalise)
    kind = "array<struct<start:bigint,end:bigint,bits:double>>"
    personal = found.where(F.size("spans") > 0).join(told, "key", "left")
    known = F.transform(located(F.col("masked"), TERM), lambda w: F.struct(w.start.alias("start"), w.end.alias("end"), F.element_at("telling", F.lower(w.value)).alias("bits")))
    mentions = F.when(F.col("telling").isNotNull(), F.filter(known, lambda s: s.bits.isNotNull())).otherwise(F.array().cast(kind))
    personal = personal.select("id", "spans", mentions.alias("terms"), "text")
    base = F.transform("spans", lambda s: F.struct(s.start.alias("start"), s.end.alias("end"), F.concat(F.lit("["), F.upper(s.kind), F.lit("]")).alias("put")))
    more = F.transform("terms", lambda s: F.struct(s.start.alias("start"), s.end.alias("end"), F.when(s.bits <= remove, F.lit("")).otherwise(F.lit("[TERM]")).alias("put")))
    personal = personal.select("id", "spans", "terms", _replaced(F.col("text"), _in_order(F.concat(base, more))).alias("text"))
    personal = personal.withColumns({"chars": F.length("text").cast("long"), "sha256": F.sha2("text", 256)})
    clean = found.where(F.size("spans") == 0).select("id", "spans", F.array().cast(kind).alias("terms"), "text", "chars", "sha256")
    return personal.unionByName(clean)


def op1_private_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: personal data and telling terms of every document, and what its text is without them."""
    found = sanitise(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("spans", lambda s: s.kind == k)).cast("long").alias(f"n_{k}")
    base = _written_spans(F.col("spans"))
    terms = F.transform("terms", lambda s: F.concat_ws(":", F.lit("term"), s.start.cast("string"), s.end.cast("string")))
    return found.select(
        F.col("id").alias("doc_id"),
        *map(count, KINDS),
        F.sha2(base, 256).alias("base_sha256"),
        F.concat_ws(",", F.when(F.size("spans") > 0, base), F.when(F.size("terms") > 0, F.array_join(terms, ","))).alias("spans"),
        F.size("terms").cast("long").alias("n_term"),
        F.col("chars").alias("sanitised_chars"),
        F.col("sha256").alias("sanitised_sha256"),
    )
