r"""Personal data: exact base forms, and identifiers found by bootstrapped lexical patterns.

DataFrame functions only. The base finds emails, addresses, cards and phones by their form. Its
spans as wholes and credentials in well-known forms are the seeds of the method. Other instances
are white-space tokens of any length with a digit or an @ (numbers that single spaces part count
as one; edges and a label as in `id=` are cut off) and, inside tokens, runs of 8 and more letters and
digits. Each has lexical patterns: its shape with the words before it, its shape with its prefix,
and, of wholes, the last word before it alone. Patterns and instances form a graph that is scored
in turns: a pattern is worth the mean of its distinct instances, an instance its best pattern.
Instances of patterns worth trusting are found although no form names them, as kind `secret` or
as the kind of their seeds. Values without letters have only the word before them as pattern, since
the base's checks (Luhn, octets, lengths) reject equal shapes; that pattern counts seeds alone, and
needs the more of them the more frequent their kind is. A token without digit and @ is never found.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let, of_row, with_row, written
from .spans import find_all, part, pieces, replaced

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret")
ROUNDS = 3
LEAST_WORTH = 0.6
LEAST_INSTANCES = 3  # distinct ones that a pattern needs
_MARK = "\x01"  # stands for the inner dots of a domain, one for one
_LOCAL = "A-Za-z0-9._%+\\-"
#: Patterns on prepared texts of equal length. A match begins where a run does or a match ended
#: (\G), and runs are possessive: as the plain pattern finds, without trying a run from each of its places.
_EMAIL = rf"(?:(?<![{_LOCAL}{_MARK}])|\G)[{_LOCAL}{_MARK}]++@[A-Za-z0-9\-]++{_MARK}[A-Za-z0-9\-{_MARK}]++"
_IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = r"[0-9][0-9_]+"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_PART = r"(?<![A-Za-z0-9])[A-Za-z]*+[0-9][A-Za-z0-9]*+"
_GLUE = "\x02"  # stands for single spaces between numbers, one for one
_NUMBER = r"[0-9().+/\-]"
_GAP = rf"(?<=[0-9)])(?<=(?<!\S){_NUMBER}{{1,64}}) (?={_NUMBER}{{1,64}}(?:[\s,;:!?]|$))(?=[(+]{{0,2}}[0-9])"
_WHOLE = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
_LEAD = r"^[^\p{L}\p{N}+(]*+(?:[A-Za-z_\-]++[=:](?!//)[^\p{L}\p{N}+(]*+)?"
_TRAIL = r"(?<=[\p{L}\p{N}=_])[^\p{L}\p{N}=_]++$"
#: Words that name a credential, and a key id's public form.
_NAMED = r"(?i)(?:token|password|passwd|pwd|secret|api[_-]?key|access[_-]?key|credential)[\"']?\s*[=:]\s*[\"']?$"
_KEY_ID = r"^(?:AKIA|ASIA)[0-9A-Z]{16}$"

_FOUND = "array<struct<start:bigint,end:bigint,value:string>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def summed(d: Column) -> Column:
        at = lambda i: F.substring(d, F.length(d) - i, F.lit(1)).cast("int")  # noqa: E731  from the right, from 0
        doubled = lambda x: F.when(x > 4, 2 * x - 9).otherwise(2 * x)
        return F.aggregate(F.sequence(F.lit(0), F.length(d) - 1), F.lit(0), lambda acc, i: acc + F.when(i % 2 == 1, doubled(at(i))).otherwise(at(i))) % 10 == 0

    return let(digits, summed)


def base_spans(text: Column) -> dict[str, Column]:
    """By kind the spans of the base (start, end, value as searched); `text` isn't null. Texts that can't hold a kind aren't searched for it."""
    none = F.array().cast(_FOUND)
    dotted = F.regexp_replace(F.translate(text, _MARK, " "), r"(?<=[A-Za-z0-9\-])\.(?=[A-Za-z0-9\-])", _MARK)
    email = F.when(F.contains(text, F.lit("@")), find_all(dotted, _EMAIL)).otherwise(none)
    octet = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
    ip = F.when(text.rlike(r"[0-9]\.[0-9]"), F.filter(find_all(text, _IP), lambda s: s["value"].rlike(rf"^{octet}\.{octet}\.{octet}\.{octet}$"))).otherwise(none)
    joined = F.regexp_replace(F.regexp_replace(text, r"[^0-9 \-]", "x"), r"(?<=[0-9])[ \-](?=[0-9])", "_")

    def is_card(s: Column) -> Column:
        return let(_digits(s["value"]), lambda x: F.length(x).between(12, 19) & F.when(F.length(x).between(12, 19), _luhn(x)).otherwise(F.lit(False)))

    card = F.when(text.rlike(r"[0-9](?:[ \-]?[0-9]){11}"), F.filter(find_all(joined, _CARD), is_card)).otherwise(none)
    phone = F.when(F.contains(text, F.lit("+")), F.filter(find_all(text, _PHONE), lambda s: F.length(_digits(s["value"])).between(9, 15))).otherwise(none)
    return {"email": email, "ip": ip, "card": card, "phone": phone}


def _blanked(text: Column, text_pieces: Column, spans: Column) -> Column:
    """`text` with spaces for all that the spans (ordered by start) cover."""

    def blank(s: Column, reached: Column) -> Column:
        start = F.greatest(s["start"], reached)
        return F.concat(part(text_pieces, reached, start), F.repeat(F.lit(" "), F.greatest(s["end"] - start, F.lit(0)).cast("int")))

    return replaced(text, text_pieces, spans, blank)


def _instances(text: Column, text_pieces: Column, base: Column) -> Column:
    """The base's spans, whole tokens and parts of tokens beside them: span, value, the 24 characters before, whole or not, kind if of the base."""
    kind = "array<struct<start:bigint,end:bigint,value:string,before:string,whole:boolean,base:string>>"
    of = lambda s: part(text_pieces, s["start"], s["end"])
    before = lambda s: part(text_pieces, F.greatest(s["start"] - 24, F.lit(0)), s["start"])

    def described(spans: Column, whole: bool, base_kind) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), of(s).alias("value"), before(s).alias("before"), F.lit(whole).alias("whole"), base_kind(s).alias("base"))).cast(kind)

    def cut(s: Column) -> Column:
        def edges(v: Column) -> Column:
            start = s["start"] + F.length(F.regexp_extract(v, _LEAD, 0))
            return F.struct(start.alias("start"), F.greatest(start, s["end"] - F.length(F.regexp_extract(v, _TRAIL, 0))).alias("end"))

        return let(of(s), edges)

    def beside(rest: Column) -> Column:
        glued = F.regexp_replace(F.translate(rest, _GLUE, " "), _GAP, _GLUE)
        wholes = F.filter(F.transform(find_all(glued, _WHOLE), cut), lambda s: of(s).rlike("[0-9@]"))
        parts = F.filter(find_all(rest, _PART), lambda s: s["end"] - s["start"] >= 8)
        none = lambda s: F.lit(None).cast("string")
        return F.concat(described(wholes, True, none), described(parts, False, none))

    return F.concat(described(base, True, lambda s: s["kind"]), let(_blanked(text, text_pieces, base), beside))


def _short(x: Column) -> Column:
    return F.when(F.length(x) > 128, F.sha2(x, 256)).otherwise(x)


def _patterns(value: Column, before: Column, whole: Column) -> Column:
    """What stands before with the shape, the leading letters with the shape, and of wholes the last word before."""
    plain = value.rlike("^[A-Za-z0-9]+$")
    kind = F.when(value.rlike("^[0-9a-f]+$|^[0-9A-F]+$"), "hex").when(value.rlike("^[0-9A-Z]+$"), "upper").otherwise("mixed")
    runs = F.regexp_replace(F.regexp_replace(value, r"\p{L}+", "a"), "[0-9]+", "9")
    shape = F.when(plain, F.concat_ws(":", kind, F.length(value).cast("string"))).otherwise(F.concat(F.lit("runs:"), _short(runs)))
    words = F.regexp_extract(F.lower(before), r"(?:[^\s]+\s+)?[^\s]*$|\s+$", 0)
    left = F.regexp_replace(F.regexp_replace(words, r"\s+", " "), "[0-9]", "9")
    prefix = F.when(~plain | (kind == "hex"), "").otherwise(F.substring(F.regexp_extract(value, "^[A-Za-z]+", 0), 1, 4))
    last = F.regexp_extract(F.lower(before), r"(?<!\S)[^\s]*\p{L}[^\s]*(?:\s+[^\s\p{L}]*)*$", 0)
    word = F.when(whole & (last != ""), F.concat(F.lit("word "), F.regexp_replace(F.regexp_replace(last, r"\s+", " "), "[0-9]+", "9")))
    named = F.when(value.rlike(r"[\p{L}@]"), F.array(F.concat(F.lit("left "), shape, F.lit(" "), left), F.concat(F.lit("form "), shape, F.lit(" "), prefix))).otherwise(F.array().cast("array<string>"))
    return F.concat(named, F.array_compact(F.array(word)))


def trusted_patterns(instances: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """pattern, kind of the patterns worth trusting. instances: value, patterns, seed (kind or null).

    Every distinct instance counts once, so copies of a document don't raise a pattern; sums are
    partial before each shuffle. A word before is worth what its seeds make it, once and for all.
    """
    edges = written(instances.select(F.explode("patterns").alias("pattern"), F.col("value"), F.col("seed")).groupBy("pattern", "value").agg(F.max("seed").alias("seed")), "edges")
    # only patterns of at least one seed or of an instance that shares a pattern with one can gain worth
    sizes = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_INSTANCES)
    known = written(edges.join(sizes, "pattern"), "graph")
    is_word = F.col("pattern").startswith("word ")
    worded = edges.where(is_word)
    # of all values that follow a word, the share of each kind: what chance alone gives
    shares = worded.where("seed is not null").groupBy(F.col("seed").alias("kind")).agg(F.count(F.lit(1)).alias("_of")).crossJoin(F.broadcast(worded.agg(F.count(F.lit(1)).alias("_all")))).select("kind", (F.col("_of") / F.col("_all")).alias("share"))
    by_kind = known.where(is_word & F.col("seed").isNotNull()).groupBy("pattern", F.col("seed").alias("kind")).agg(F.count(F.lit(1)).alias("_of"), F.max("n").alias("n"))
    word_worth = by_kind.join(F.broadcast(shares), "kind").select("pattern", "kind", (F.col("_of") / (F.col("n") + 2 + 8 * F.col("share"))).alias("worth"))
    words = written(word_worth.where(F.col("worth") >= LEAST_WORTH), "words")
    graph = known.where(~is_word)
    seeds = known.where("seed is not null").select("value", F.col("seed").alias("kind"), F.lit(1.0).alias("worth")).distinct()
    by_word = known.where(is_word & F.col("seed").isNull()).join(words, "pattern").select("value", "kind", "worth")
    worth = seeds.unionByName(by_word.groupBy("value", "kind").agg(F.max("worth").alias("worth")))
    scored = None
    for i in range(rounds):
        scored = graph.join(worth, "value").groupBy("pattern", "kind").agg((F.sum("worth") / (F.max("n") + 0.5)).alias("worth"))
        if i + 1 == rounds:
            break
        best = graph.where("seed is null").join(scored, "pattern").select("value", "kind", "worth").unionByName(by_word).groupBy("value", "kind").agg(F.max("worth").alias("worth"))
        worth = written(seeds.unionByName(best.where(F.col("worth") >= LEAST_WORTH / 4)), "worth")
    scored = scored.unionByName(words)
    good = scored.where(F.col("worth") >= LEAST_WORTH)
    return written(good.groupBy("pattern").agg(F.max(F.struct("worth", "kind"))["kind"].alias("kind")), "patterns")


def personal_data(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, h (hash of the text), base and spans: lists of (start, rank, kind, end), ordered by start, then kind.

    `spans` has the base and what the method adds. Null text: empty. Null ids and repeated rows
    are rows like others; seeds and patterns count distinct values. Other columns don't matter.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    span = "array<struct<start:bigint,rank:int,kind:string,end:bigint>>"

    def ranked(kind: str, spans: Column) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), F.lit(kind).alias("kind"), s["end"].alias("end")))

    base = F.array_sort(F.concat(*[ranked(k, s) for k, s in base_spans(body).items()]).cast(span))
    cut = let(pieces(body), lambda p: let(base, lambda b: F.struct(b.alias("base"), _instances(body, p, b).alias("tokens"))))
    found = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(body).alias("h"), F.when(body.rlike("[0-9@]"), cut).alias("both"))
    narrow = written(found.select("doc_id", "h", F.coalesce("both.base", F.array().cast(span)).alias("base"), F.col("both.tokens").alias("tokens")), "personal")
    each = narrow.where(F.size("tokens") > 0).select("doc_id", "h", F.explode("tokens").alias("t"))
    named = F.when((F.length("t.value") >= 12) & F.col("t.value").rlike("[0-9]") & ~F.col("t.value").rlike("^[0-9]+$|://") & F.col("t.before").rlike(_NAMED), "secret").when(F.col("t.value").rlike(_KEY_ID), "secret")
    patterns = _patterns(F.col("t.value"), F.col("t.before"), F.col("t.whole"))
    rows = written(each.select("doc_id", "h", "t.start", "t.end", _short(F.col("t.value")).alias("value"), patterns.alias("patterns"), F.col("t.base").isNotNull().alias("known"), F.coalesce("t.base", named).alias("seed")), "instances")
    trusted = trusted_patterns(rows.select("value", "patterns", "seed"))
    open_rows = rows.where(~F.col("known")).select("doc_id", "h", "start", "end", "seed", F.explode_outer("patterns").alias("pattern"))
    hits = open_rows.join(trusted, "pattern", "left").where("kind is not null or seed is not null").groupBy("doc_id", "h", "start", "end").agg(F.coalesce(F.max("seed"), F.max("kind")).alias("kind"))
    # of readings of one token the widest
    reach = Window.partitionBy("doc_id", "h").orderBy("start", F.col("end").desc()).rowsBetween(Window.unboundedPreceding, -1)
    hits = hits.withColumn("_reach", F.max("end").over(reach)).where(F.col("_reach").isNull() | (F.col("end") > F.col("_reach"))).drop("_reach")
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int") - 1
    added = hits.groupBy("doc_id", "h").agg(F.collect_list(F.struct("start", rank.alias("rank"), "kind", "end")).cast(span).alias("added"))
    added = added.select(F.col("doc_id").alias("_id"), F.col("h").alias("_h"), "added")
    both = narrow.join(added, narrow["doc_id"].eqNullSafe(added["_id"]) & (F.col("h") == F.col("_h")), "left")
    return both.select("doc_id", "h", "base", F.array_sort(F.concat("base", F.coalesce("added", F.array().cast(span)))).alias("spans"))


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def masked(text: Column, spans: Column) -> Column:
    """`text` with each span as its kind in angle brackets; of spans that overlap the first names the whole."""

    def mask(p: Column) -> Column:
        named = lambda s, reached: F.concat(part(p, reached, s["start"]), F.lit("<"), s["kind"], F.lit(">"))
        return replaced(text, p, spans, lambda s, reached: F.when(s["start"] >= reached, named(s, reached)).otherwise(""))

    return F.when(F.size(spans) > 0, let(pieces(text), mask)).otherwise(text)


def digest_columns(found: DataFrame, kinds: Sequence[str] = BASE_KINDS) -> DataFrame:
    """doc_id, the count of each base kind, sha256 of the base's spans, all spans as text, and how many they are."""
    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    counts = [count(k) for k in kinds]
    return found.select("doc_id", *counts, F.sha2(span_text(F.col("base")), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"), F.size("spans").cast("bigint").alias("n_spans"))


def mask_documents(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """`docs` with all spans found in their texts masked; null and empty texts stay as they are.

    Rows without an id and repeated rows are masked like others. Columns may have any names.
    """
    found = personal_data(docs, text, doc_id).where(F.size("spans") > 0).dropDuplicates(["doc_id", "h"])
    found = found.select(F.col("doc_id").alias("found_id"), F.col("h").alias("found_h"), "spans")
    body = F.col(f"`{text}`")
    rows = with_row(docs, [text], doc_id=F.col(f"`{doc_id}`"), text=body, h=F.xxhash64(F.coalesce(body, F.lit(""))))
    both = rows.join(found, F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("h") == F.col("found_h")), "left")
    out = F.when(F.col("spans").isNull(), F.col("text")).otherwise(masked(F.col("text"), F.col("spans")))
    return both.select(*of_row(docs, **{text: out}))
