"""Personal data: base patterns, and terms that would give a protected entity away.

Only DataFrame functions. The values that the base patterns find are the protected entities, in a normal form. A term is a
word; from the corpus come the texts that hold it, those that hold the entity, and those that hold both. With p the share of
texts with the entity and q the smoothed share among the texts with the term, the term discloses 1 - log q / log p of the
entity's information (their pointwise mutual information over the entity's own content). Terms above the threshold are
sanitised wherever they occur: generalised to what kind of word they are, or removed where they disclose nearly all.

What one text holds tells nothing, since all its words share that text with the entity, and a near copy is the same text once
more, however many there are: two independent texts at least must hold both. Of the texts that do, one must have none of
SEEDS least hashes of five-word windows in common with the first. Entities that stand in the same texts are one class, and so
are terms, so that lists that repeat each other do not multiply into pairs.

Cases: null and empty texts have no spans; texts are taken whole, and every pattern runs in time that is linear in them;
texts that are equal count once in the statistics, so copies alone disclose nothing; repeated rows come out as often as
they came in; null ids are told apart by their text; ties go to the larger share; an empty table gives no rows; other columns
are neither read nor changed (`sanitise` carries them in a struct, so no name clashes).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, identified, materialise

# The base patterns, in the order of their kinds. A match starts at the end of the last match or where the
# character before is none of its own, which is the leftmost place; runs are possessive, because nothing follows that
# could make them give back.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"(?:\G|(?<![0-9]))[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a pattern to be tried.
NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
KINDS = list(PATTERNS)
TERM = "term"
DOC = ["doc", "body"]
#: Share of the entity's information that a term must disclose; above REMOVE it is removed; texts of the smoothing, in which
#: the term would meet the entity no more often than any text does.
DISCLOSURE, REMOVE, PRIOR = 0.9, 0.98, 1.0
#: Least hashes that tell near copies, and words of the windows that they are taken over.
SEEDS, WINDOW_WORDS = 16, 5
#: A term: letters, marks and digits, with single apostrophes and hyphens inside; two characters at least.
WORD = r"[\p{L}\p{M}\p{N}]++(?:['\u2019-][\p{L}\p{M}\p{N}]++)*+"
MIN_TERM = 2
#: Characters of the blocks that a text is cut into before pieces are taken out of it.
BLOCK = 4096


def valid(kind: Column, found: Column) -> Column:
    digits = F.regexp_replace(found, "[^0-9]", "")
    size = F.char_length(digits)
    parts = F.transform(F.split(found, r"\."), lambda p: F.ltrim(p, F.lit("0")))
    small = F.forall(parts, lambda p: (F.char_length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(0)) <= 255))
    return (
        F.when(kind == "ip", small)
        .when(kind == "card", size.between(12, 19) & F.expr("luhn_check(regexp_replace(found, '[^0-9]', ''))"))
        .when(kind == "phone", size.between(9, 15))
        .otherwise(F.lit(True))
    )


def entity_of(kind: Column, found: Column) -> Column:
    """The normal form of a value: digits of cards and phones, parts of an ip without leading zeros, an e-mail in lower case
    and without a +tag."""
    email = F.regexp_replace(ascii_lower(found), r"\+[^@]*@", "@")
    ip = F.array_join(F.transform(F.split(found, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "")), ".")
    return F.concat_ws(":", kind, F.when(kind == "email", email).when(kind == "ip", ip).otherwise(F.regexp_replace(found, "[^0-9]", "")))


def same(a: DataFrame, b: DataFrame) -> Column:
    """The rows are of one document, null ids included."""
    return a["doc"].eqNullSafe(b["doc"]) & (a["body"] == b["body"])


def ends(each: DataFrame, *keys: str) -> DataFrame:
    """Matches with columns `start` and `end`, from the lengths of the gaps between them."""
    order = Window.partitionBy(*keys).orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    placed = each.withColumn("end", F.sum(F.col("gap") + F.char_length("found")).over(order).cast("int"))
    return placed.withColumn("start", F.col("end") - F.char_length("found"))


def suspects(texts: DataFrame) -> DataFrame:
    """The texts in which some base pattern matches, valid or not: all that the entities' statistics need."""
    text = F.col("text")
    seen = [(F.contains(text, F.lit(NEEDS[k])) if NEEDS[k] else text.rlike("[0-9]")) & text.rlike(p) for k, p in PATTERNS.items()]
    return texts.where(seen[0] | seen[1] | seen[2] | seen[3]).distinct()


def base_spans(texts: DataFrame) -> DataFrame:
    """(doc, body, kind, start, end, found): what the base patterns find."""
    text = F.col("text")
    tried = F.array(*(F.when(F.contains(text, F.lit(need)) if need else text.rlike("[0-9]"), F.lit(k)) for k, need in NEEDS.items()))
    rows = texts.select(*DOC, "text", F.explode(F.array_compact(tried)).alias("kind"))
    choose = lambda f: F.coalesce(*(F.when(F.col("kind") == k, f(p)) for k, p in PATTERNS.items()))
    hits = rows.withColumn("hits", choose(lambda p: F.regexp_extract_all("text", F.lit(p), 0))).where(F.size("hits") > 0)
    gaps = hits.select(*DOC, "kind", "hits", choose(lambda p: F.split("text", p, -1)).alias("gaps"))
    each = gaps.select(*DOC, "kind", F.posexplode(F.arrays_zip("gaps", "hits")).alias("nth", "z")).where(F.col("z.hits").isNotNull())
    spans = ends(each.select(*DOC, "kind", "nth", F.char_length("z.gaps").alias("gap"), F.col("z.hits").alias("found")), *DOC, "kind")
    return spans.where(valid(F.col("kind"), F.col("found"))).select(*DOC, "kind", "start", "end", "found")


def term_hashes(texts: DataFrame, *keep: str) -> DataFrame:
    """Columns `keep` and `term`: the hash of each different word of a text."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(WORD), 0))
    each = texts.select(*keep, F.explode(words).alias("word")).where(F.char_length("word") >= MIN_TERM)
    return each.select(*keep, F.xxhash64("word").alias("term"))


def copy_marks(texts: DataFrame) -> DataFrame:
    """(body, marks): SEEDS least hashes of the windows of a text's words; near copies share some of them."""
    words = texts.select("body", F.split(F.lower("text"), r"[\x20\x09-\x0D]+").alias("words"))
    windows = F.transform("words", lambda w, i: F.xxhash64(w, *(F.get("words", i + k) for k in range(1, WINDOW_WORDS))))
    least = lambda seed: F.array_min(F.transform("h", lambda x: F.xxhash64(F.lit(seed), x)))
    return words.select("body", windows.alias("h")).select("body", F.array(*map(least, range(SEEDS))).alias("marks"))


def classes(held: DataFrame, member: str, name: str) -> tuple[DataFrame, DataFrame]:
    """Members that stand in the same texts are one class: (member, class) and (class, n, body), for two texts and more."""
    digest = held.groupBy(member).agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("body")).alias("a"), F.bit_xor(F.xxhash64(F.lit("second"), "body")).alias("b"))
    own = materialise(digest.where("n > 1").select(member, F.xxhash64("n", "a", "b").alias(name), F.col("n").alias(f"{name}_n")), name)
    first = own.groupBy(name, f"{name}_n").agg(F.min(member).alias(member))
    return own, held.join(first, member).select(name, f"{name}_n", "body")


def share_of(n_both: Column, n_term: Column, n_entity: Column, n_texts: int) -> Column:
    """Share of the entity's information that the term discloses, smoothed."""
    p = n_entity / F.lit(float(max(1, n_texts)))
    q = (n_both + PRIOR * p) / (n_term + PRIOR)
    return F.when(p < 1, 1 - F.ln(q) / F.ln(p)).otherwise(F.lit(0.0))


def independent(held: DataFrame, *keys: str) -> DataFrame:
    """The groups (by keys) in which a text shares no least hash with the first one. held: keys, body, marks."""
    first = held.groupBy(*keys).agg(F.min_by("marks", "body").alias("first"))
    alike = F.exists(F.zip_with("marks", "first", lambda a, b: a.eqNullSafe(b)), lambda same: same)
    return held.join(first, list(keys)).where(~alike).select(*keys).distinct()


def disclosing_terms(texts: DataFrame, suspect: DataFrame, spans: DataFrame, disclosure: float = DISCLOSURE) -> tuple[DataFrame, DataFrame] | None:
    """(term, share): words that disclose an entity, with the largest share of an entity's information that they give away,
    and (doc, body, term): where the words that came into question stand. None where no word can disclose any.

    Only entities with independent texts go on. Their words are counted in ever more texts: those with such entities, those
    with any entity, a sixteenth of the corpus, and all of it. Each count is no larger than the next, so a word that is too
    frequent already drops out, and the pass over the whole corpus looks for rare words alone.
    """
    entities = materialise(spans.select("body", entity_of(F.col("kind"), F.col("found")).alias("entity")).distinct(), "entities")
    standing = materialise(classes(entities, "entity", "e")[1], "entity-texts")
    if standing.isEmpty():
        return None
    holding = suspect.join(standing.select("body").distinct(), "body", "left_semi")
    among = materialise(holding.select("body", "text").dropDuplicates(["body"]), "entity-holders")
    marks = materialise(copy_marks(among), "copy-marks")
    standing = materialise(standing.join(independent(standing.join(marks, "body"), "e"), "e", "left_semi"), "independent-entity-texts")
    if standing.isEmpty():
        return None
    n_texts = texts.select("body").distinct().count()
    few = among.join(standing.select("body").distinct(), "body", "left_semi")
    members, words = classes(materialise(term_hashes(few, "body"), "entity-words"), "term", "t")
    pairs = standing.join(words, "body").where(share_of(F.least("e_n", "t_n"), F.col("t_n"), F.col("e_n"), n_texts) >= disclosure)
    counts = pairs.groupBy("e", "e_n", "t", "t_n").agg(F.count(F.lit(1)).alias("n_both")).where("n_both > 1")
    strong = counts.where(share_of(F.col("n_both"), F.col("t_n"), F.col("e_n"), n_texts) >= disclosure)
    both = materialise(pairs.select("e", "e_n", "t", "body").join(strong.select("e", "t", "n_both"), ["e", "t"]).join(marks, "body"), "shared-texts")
    together = independent(both, "t", "e", "e_n", "n_both").select("t", "e_n", "n_both").distinct()
    found = materialise(together.join(members, "t").select("term", "e_n", "n_both").distinct(), "term-pairs")
    held = None
    for part, rows in (("suspect", suspect), ("sample", texts.where(F.pmod("body", F.lit(16)) == 0)), ("whole", texts)):
        wanted = materialise(found.select("term").distinct(), f"wanted-{part}")
        if wanted.isEmpty():
            return None
        held = materialise(term_hashes(rows, *DOC).join(wanted, "term", "left_semi"), f"term-holders-{part}")
        counted = held.select("body", "term").distinct().groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
        placed = found.select("term", "e_n", "n_both").join(counted, "term", "left")
        shared = placed.withColumn("share", share_of(F.col("n_both"), F.greatest("n_term", "n_both"), F.col("e_n"), n_texts))
        found = materialise(shared.where(F.col("share") >= disclosure).select("term", "e_n", "n_both", "share"), f"shares-{part}")
    return found.groupBy("term").agg(F.max("share").alias("share")), held


def term_spans(rows: DataFrame, holders: DataFrame) -> DataFrame:
    """(doc, body, kind, start, end, found, share) of the disclosing words in their holders' texts."""
    zipped = F.arrays_zip(F.split("text", WORD, -1).alias("gap"), F.regexp_extract_all("text", F.lit(WORD), 0).alias("found"))
    each = rows.select(*DOC, F.posexplode(zipped).alias("nth", "z")).select(*DOC, "nth", F.char_length("z.gap").alias("gap"), "z.found").where(F.col("found").isNotNull())
    each = ends(each, *DOC).withColumn("term", F.xxhash64(F.lower("found")))
    hit = each.join(holders, same(each, holders) & (each["term"] == holders["term"]))
    return hit.select(each["doc"], each["body"], F.lit(TERM).alias("kind"), "start", "end", "found", "share")


def clear_of_base(spans: DataFrame) -> DataFrame:
    """The spans without terms that overlap a base span."""
    by = Window.partitionBy(*DOC).orderBy("start")
    base_end, base_start = (F.when(F.col("kind") != TERM, F.col(c)) for c in ("end", "start"))
    left = F.max(base_end).over(by.rangeBetween(Window.unboundedPreceding, 0))
    right = F.min(base_start).over(by.rangeBetween(0, Window.unboundedFollowing))
    held = spans.withColumn("left", left).withColumn("right", right)
    return held.where((F.col("kind") != TERM) | (F.coalesce(F.col("left") <= F.col("start"), F.lit(True)) & F.coalesce(F.col("right") >= F.col("end"), F.lit(True)))).drop("left", "right")


def detect(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(doc, body, kind, rank, start, end, found, share): every span; and (doc, body, text) of all rows that have any."""
    texts = identified(docs, id_col, text)
    suspect = materialise(suspects(texts), "suspects")
    base = materialise(base_spans(suspect).withColumn("share", F.lit(1.0)), "base-spans")
    rank = F.array_position(F.array(*map(F.lit, [*KINDS, TERM])), F.col("kind")).cast("int")
    found = disclosing_terms(texts, suspect, base.drop("share"))
    if found is None:
        return base.withColumn("rank", rank), suspect
    terms, held = found
    holders = materialise(held.join(terms, "term").distinct(), "disclosing")
    docs_with = holders.select(*DOC).distinct()
    rows = materialise(texts.join(docs_with, same(texts, docs_with), "left_semi").select("doc", "body", "text").distinct(), "holder-texts")
    spans = materialise(clear_of_base(base.unionByName(term_spans(rows, holders))).withColumn("rank", rank), "spans")
    return spans, suspect.unionByName(rows.join(suspect, same(rows, suspect), "left_anti"))


def islands(spans: DataFrame) -> DataFrame:
    """(doc, body, islands): spans that overlap are one, in place of which its first kind stands; an array in their order."""
    by = Window.partitionBy(*DOC).orderBy("start", "rank")
    reach = F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1))
    first = F.coalesce(F.col("start") >= reach, F.lit(True)).cast("int")
    shape = F.when(F.col("found").rlike(r"\p{N}"), "[number]").when(F.col("found").rlike(r"^\p{Lu}"), "[name]").otherwise("[word]")
    instead = F.when(F.col("kind") != TERM, F.concat(F.lit("["), F.col("kind"), F.lit("]"))).when(F.col("share") >= REMOVE, "").otherwise(shape)
    each = spans.withColumn("instead", instead).withColumn("first", first).withColumn("island", F.sum("first").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    merged = each.groupBy(*DOC, "island").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min_by("instead", F.struct("start", "rank")).alias("instead"))
    return merged.groupBy(*DOC).agg(F.sort_array(F.collect_list(F.struct("start", "end", "instead"))).alias("islands"))


def cleaned(text: str, found: str) -> Column:
    """The text with every island replaced. It is cut into blocks first, so that a piece costs its own length and no more."""
    cut = lambda a, b: f"substring(array_join(slice(_blocks, ({a}) DIV {BLOCK} + 1, greatest(0, (({b}) - 1) DIV {BLOCK} - ({a}) DIV {BLOCK} + 1)), ''), ({a}) % {BLOCK} + 1, greatest(0, ({b}) - ({a})))"
    before = f"(CASE WHEN i = 0 THEN 0 ELSE {found}[i - 1].end END)"
    parts = f"transform({found}, (s, i) -> concat({cut(before, 's.start')}, s.instead))"
    last = f"element_at({found}, -1).end"
    return F.expr(f"concat(array_join({parts}, ''), {cut(last, f'char_length({text})')})")


def replaced(rows: DataFrame) -> DataFrame:
    """rows (text, islands, ...) with column `clean`; rows without islands keep their text."""
    blocks = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{BLOCK}}}"), 0)
    held = rows.withColumn("_blocks", F.when(F.col("islands").isNotNull(), blocks))
    return held.withColumn("clean", F.when(F.col("islands").isNull(), F.col("text")).otherwise(cleaned("text", "islands"))).drop("_blocks")


def report(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per row: id, counts of the base kinds, base_sha256, spans, n_term, and the digest of the sanitised text."""
    spans, texts = detect(docs, id_col, text)
    listed = lambda xs: F.array_join(F.transform(xs, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    gathered = spans.groupBy(*DOC).agg(F.sort_array(F.collect_list(F.struct("start", "rank", "kind", "end"))).alias("spans"))
    base = F.filter("spans", lambda x: x["kind"] != TERM)
    counts = [F.expr(f"CAST(size(filter(spans, x -> x.kind = '{k}')) AS BIGINT) AS n_{k}") for k in (*KINDS, TERM)]
    digests = gathered.select(*DOC, *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
    cut = islands(spans)
    clean = replaced(texts.join(cut, same(texts, cut)).select(texts["doc"], texts["body"], "text", "islands")).select("doc", "body", F.sha2("clean", 256).alias("clean_sha256"))
    digests = digests.join(clean, same(digests, clean)).select(digests["doc"].alias("_doc"), digests["body"].alias("_body"), *(f"n_{k}" for k in (*KINDS, TERM)), "base_sha256", "spans", "clean_sha256")
    digests = materialise(digests, "pii")
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(whole).alias("_hash"), F.sha2(whole, 256).alias("_sha"))
    joined = rows.join(digests, rows["_id"].eqNullSafe(digests["_doc"]) & (rows["_hash"] == digests["_body"]), "left")
    none = {k: F.coalesce(f"n_{k}", F.lit(0)).cast("bigint").alias(f"n_{k}") for k in (*KINDS, TERM)}
    empty = F.coalesce("base_sha256", F.sha2(F.lit(""), 256)).alias("base_sha256")
    return joined.select(F.col("_id").alias(id_col), *(none[k] for k in KINDS), empty, F.coalesce("spans", F.lit("")).alias("spans"), none[TERM], F.coalesce("clean_sha256", "_sha").alias("sanitised_sha256"))


def sanitise(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, clean): the rows as structs, so that no column clashes; base finds become their kind, disclosing words what kind
    of word they are, or nothing. A null text stays null."""
    spans, _ = detect(docs.select(id_col, text), id_col, text)
    found = materialise(islands(spans), "islands")
    rows = docs.select(F.struct(*(f"`{c}`" for c in docs.columns)).alias("row"), F.col(id_col).alias("_doc"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("_body"))
    joined = rows.join(found, F.col("_doc").eqNullSafe(F.col("doc")) & (F.col("_body") == F.col("body")), "left").withColumn("text", F.col("row").getField(text))
    return replaced(joined).select("row", "clean")
