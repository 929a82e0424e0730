"""Personal data replaced by keyed surrogates, in DataFrame functions only.

One pattern finds mail addresses, IP addresses, IBANs, social security, card and phone numbers, and
persons after a title. Each entity has a canonical form (digits only, lower case), so spellings of the same entity
get the same surrogate in the whole corpus, rendered in the format of each place: marks, lengths and letter
case stay, card numbers keep a valid check digit, a phone number its country code, a name its gender (by
the title) and script; each word of a name is an entity, so "Mr. Jo Roe" and "Mr. Roe" stay the same person.

A surrogate is made from a keyed hash. Where two entities of a type get the same surrogate, or a surrogate is a real entity,
all but the smallest try again with the next attempt, until all are distinct; after ATTEMPTS the
entity is left as a clash in `surrogates` (a type's format may have fewer values than the corpus has entities).

One row per row of the input. Rows that repeat doc_id and text get the same result each. A null text stays null with no
entities. Other columns are ignored. Texts are rewritten whole. An entity in very many documents is a skewed join key,
which adaptive execution splits; the entities of one document are collected, never the documents of one entity.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwise.llm.common import durable, table

ATTEMPTS = 12
KEY = "change me"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
MALE = r"Mr|Sir|Herr|Monsieur|Señor|Sr|Г-н|Господин"
FEMALE = r"Mrs|Ms|Miss|Madam|Frau|Madame|Mme|Mlle|Señora|Sra|Г-жа|Госпожа"
OPEN = r"Dr|Prof"
_NAME = r"\p{Lu}[\p{L}'’-]+"
# order matters: the first that matches at a place wins
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "ip": rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": r"\+[0-9]{1,3}(?:[ .-]?\(?[0-9]{1,4}\)?){2,5}(?![0-9])|\([0-9]{3}\) ?[0-9]{3}[-. ][0-9]{4}(?![0-9])|(?<![0-9.-])[0-9]{3}[-. ][0-9]{3}[-. ][0-9]{4}(?![0-9])",
    "card": r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])",
    "person": rf"\b(?:{MALE}|{FEMALE}|{OPEN})\.? {_NAME}(?: {_NAME})?",
}
PATTERN = "|".join(f"(?:{p})" for p in PATTERNS.values())
_LATIN = "ba be bi bo da de di do ka ke ki ko la le li lo".split()
_CYRILLIC = "ба бе би бо да де ди до ка ке ки ко ла ле ли ло".split()


def entity_type(surface: Column) -> Column:
    out = F.when(surface.rlike(f"^(?:{PATTERNS['email']})$"), "email")
    for name in list(PATTERNS)[1:-1]:
        out = out.when(surface.rlike(f"^(?:{PATTERNS[name]})$"), name)
    gender = F.when(surface.rlike(f"^(?:{MALE})\\b"), "m").when(surface.rlike(f"^(?:{FEMALE})\\b"), "f").otherwise("x")
    return out.otherwise(F.concat(F.lit("name-"), gender))


def _script(word: Column) -> Column:
    return F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic").otherwise("latin")


def entities_of(surface: Column) -> Column:
    """Type and canonical form of the entities in one place: one, or each word of a name."""
    kind = entity_type(surface)
    one = lambda value: F.array(F.struct(kind.alias("type"), value.alias("value")))
    words = F.slice(F.split(surface, " "), 2, 8)
    last = F.size(words)
    named = F.transform(
        words,
        lambda w, i: F.struct(
            F.concat(F.when(i + 1 < last, kind).otherwise(F.lit("name-last")), F.lit("-"), _script(w)).alias("type"), F.lower(w).alias("value")
        ),
    )
    return (
        F.when(kind.startswith("name"), named)
        .when(kind == "email", one(F.lower(surface)))
        .when(kind == "ip", one(surface))
        .when(kind == "iban", one(F.regexp_replace(surface, " ", "")))
        .otherwise(one(F.regexp_replace(surface, "[^0-9]", "")))
    )


def _digits(code: Column, n: Column) -> Column:
    return F.substring(F.translate(code, "abcdef", "123456"), F.lit(1), n)


def _filled(shape: Column, code: Column) -> Column:
    """Letters and digits of a shape replaced by those of a code, one for one; marks stay."""
    long = F.concat(code, F.sha2(code, 256))
    at = lambda i: F.substring(long, i % 128 + 1, F.lit(1))
    return F.array_join(
        F.transform(
            F.split(shape, ""),
            lambda c, i: F.when(c.rlike("[0-9]"), F.translate(at(i), "abcdef", "123456"))
            .when(c.rlike("[A-Z]"), F.translate(at(i), "0123456789abcdef", "KLMNOPQRSTUVWXYZ"))
            .when(c.rlike("[a-z]"), F.translate(at(i), "0123456789abcdef", "ghijklmnopqrstuv"))
            .otherwise(c),
        ),
        "",
    )


def _with_check_digit(body: Column) -> Column:
    """A number with the digit that makes its Luhn sum a multiple of ten."""
    digits = F.reverse(F.transform(F.split(body, ""), lambda c: c.cast("int")))
    doubled = F.transform(digits, lambda d, i: F.when(i % 2 == 0, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d))
    total = F.aggregate(doubled, F.lit(0), lambda t, d: t + d)
    return F.concat(body, ((10 - total % 10) % 10).cast("string"))


def _syllables(code: Column, n: Column, kind: Column) -> Column:
    """A made-up name of n syllables in the script and gender of a name type."""
    pick = lambda words: F.array_join(
        F.transform(F.sequence(F.lit(1), n), lambda i: F.element_at(F.array(*map(F.lit, words)), F.conv(F.substring(code, i, F.lit(1)), 16, 10).cast("int") + 1)), ""
    )
    end = lambda m, f, last: F.when(kind.startswith("name-m"), m).when(kind.startswith("name-f"), f).when(kind.startswith("name-last"), last).otherwise("")
    return F.initcap(
        F.when(kind.endswith("cyrillic"), F.concat(pick(_CYRILLIC), end("н", "на", "вич"))).otherwise(F.concat(pick(_LATIN), end("n", "na", "ster")))
    )


def surrogate(kind: Column, value: Column, attempt: Column, key: str) -> Column:
    """The surrogate of a canonical form, itself canonical."""
    code = F.sha2(F.concat_ws("\x1f", F.lit(key), kind, value, attempt.cast("string")), 256)
    local, domain = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    host = F.translate(F.substring(F.sha2(F.concat_ws("\x1f", F.lit(key), F.lit("host"), domain), 256), 1, 8), "0123456789abcdef", "ghijklmnopqrstuv")
    more = F.when(attempt > 0, F.translate(F.substring(F.reverse(code), F.lit(1), attempt), "0123456789abcdef", "ghijklmnopqrstuv")).otherwise("")
    octet = lambda i, low, n: (F.conv(F.substring(code, i, 6), 16, 10).cast("long") % n + low).cast("string")
    size = F.length(value)
    return (
        F.when(kind == "email", F.concat(_filled(local, code), more, F.lit("@"), host, F.lit(".example")))
        .when(kind == "ip", F.concat_ws(".", octet(1, 1, 223), octet(7, 0, 256), octet(13, 0, 256), octet(19, 1, 254)))
        .when(kind == "iban", F.concat(F.substring(value, 1, 2), _filled(F.substring(value, F.lit(3), size), code)))
        .when(kind == "ssn", F.concat(F.lit("9"), _digits(code, size - 1)))
        .when(kind == "card", _with_check_digit(F.concat(F.substring(value, 1, 1), _digits(code, size - 2))))
        .when(kind == "phone", F.concat(F.substring(value, 1, 1), _digits(code, size - 1)))
        .otherwise(F.lower(_syllables(code, F.lit(3) + attempt, kind)))
    )


def render(surface: Column, kind: Column, names: Column, lookup) -> Column:
    """A place's text with its surrogate in its own format."""
    flat = lookup(F.element_at(names, 1))
    seen = lambda i: F.length(F.regexp_replace(F.substring(surface, F.lit(1), i), "[^0-9]", ""))
    digits = F.array_join(
        F.transform(F.split(surface, ""), lambda c, i: F.when(c.rlike("[0-9]"), F.substring(flat, seen(i) + 1, F.lit(1))).otherwise(c)), ""
    )
    blanks = lambda i: F.length(F.regexp_replace(F.substring(surface, F.lit(1), i), " ", ""))
    grouped = F.array_join(F.transform(F.split(surface, ""), lambda c, i: F.when(c != " ", F.substring(flat, blanks(i) + 1, F.lit(1))).otherwise(c)), "")
    named = F.concat_ws(" ", F.substring_index(surface, " ", 1), F.array_join(F.transform(names, lambda e: F.initcap(lookup(e))), " "))
    upper = F.when(surface == F.upper(surface), F.upper(flat)).otherwise(flat)
    return (
        F.when(kind.startswith("name"), named)
        .when(kind == "email", upper)
        .when(kind == "ip", flat)
        .when(kind == "iban", grouped)
        .otherwise(digits)
    )


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """type, value, surrogate and clash of distinct entities (type, value)."""
    todo = entities.withColumn("attempt", F.lit(0))
    done = None
    for attempt in range(ATTEMPTS):
        made = durable(todo.withColumn("surrogate", surrogate(F.col("type"), F.col("value"), F.lit(attempt), key)))
        turn = F.row_number().over(Window.partitionBy("type", "surrogate").orderBy("value"))
        real = entities.select("type", F.col("value").alias("surrogate"), F.lit(True).alias("real"))
        checked = made.withColumn("turn", turn).join(real, ["type", "surrogate"], "left")
        if done is not None:
            checked = checked.join(done.select("type", "surrogate", F.lit(True).alias("taken")), ["type", "surrogate"], "left")
        else:
            checked = checked.withColumn("taken", F.lit(None).cast("boolean"))
        fine = (F.col("turn") == 1) & F.col("real").isNull() & F.col("taken").isNull()
        checked = durable(checked.select("type", "value", "surrogate", fine.alias("fine")))
        won = checked.where("fine").select("type", "value", "surrogate", F.lit(False).alias("clash"))
        done = won if done is None else done.unionByName(won)
        rest = checked.where("not fine")
        if rest.isEmpty():
            return done
        todo = rest.select("type", "value", F.lit(attempt + 1).alias("attempt"))
    return done.unionByName(rest.select("type", "value", "surrogate", F.lit(True).alias("clash")))


def replace_pii(docs: DataFrame, key: str = KEY) -> DataFrame:
    """doc_id, n_entities (places), entity_types (sorted, distinct) and text with surrogates, of each row of docs."""
    found = docs.select("doc_id", "text", F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0)).alias("places"))
    parts = found.where(F.size("places") > 0).select(
        "doc_id", F.xxhash64("text").alias("print"), F.explode(F.array_distinct(F.flatten(F.transform("places", entities_of)))).alias("e")
    )
    parts = durable(parts.select("doc_id", "print", "e.type", "e.value").distinct())
    known = durable(surrogates(parts.select("type", "value").distinct(), key))
    maps = (
        parts.join(known, ["type", "value"])
        .groupBy(F.col("doc_id").alias("id"), F.col("print").alias("p"))
        .agg(F.map_from_entries(F.collect_list(F.struct(F.concat_ws("\x1f", "type", "value"), "surrogate"))).alias("of"))
    )
    joined = found.join(maps, F.col("doc_id").eqNullSafe(F.col("id")) & (F.xxhash64("text") == F.col("p")), "left")
    lookup = lambda e: F.element_at(F.col("of"), F.concat_ws("\x1f", e["type"], e["value"]))
    new = F.transform("places", lambda s: render(s, entity_type(s), entities_of(s), lookup))
    between = F.split("text", PATTERN, -1)
    merged = F.array_join(F.flatten(F.transform(between, lambda t, i: F.array(t, F.coalesce(F.get(new, i), F.lit(""))))), "")
    return joined.select(
        "doc_id",
        F.greatest(F.coalesce(F.size("places"), F.lit(0)), F.lit(0)).cast("bigint").alias("n_entities"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("places", entity_type))), ",").alias("entity_types"),
        F.when(F.col("of").isNull(), F.col("text")).otherwise(merged).alias("text"),
    )


def op7_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_pii(table(spark, sf_dir, "documents"))
