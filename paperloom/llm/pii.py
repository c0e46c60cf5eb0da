"""Surrogates for personal data.

Everything runs as DataFrame expressions. Entities are found by one pattern, so the text
between them (split) and they themselves (regexp_extract_all) interleave exactly. Each
distinct entity gets a keyed replacement of the same type and format; collisions are
looked for over the whole corpus and dealt again until all replacements are distinct.
"""

from __future__ import annotations

from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.llm.staging import staged

# Forms of address by gender.
MALE = ["Mr", "Herr", "Señor", "Sr", "Monsieur", "Signor", "Господин", "Κύριος"]
FEMALE = ["Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Madame", "Mme", "Mademoiselle", "Signora", "Госпожа", "Κυρία"]
# Titles of either.
NEUTRAL = ["Dr", "Prof", "Doctor", "Professor", "Доктор", "Профессор"]
# Syllables of made-up names and their endings by gender, per script.
SYLLABLES = {
    "latin": ["ba", "be", "da", "de", "fa", "ga", "ka", "ke", "la", "le", "ma", "me", "na", "ne", "ra", "ta"],
    "cyrillic": ["ба", "бе", "да", "де", "фа", "га", "ка", "ке", "ла", "ле", "ма", "ме", "на", "не", "ра", "та"],
    "greek": ["βα", "βε", "δα", "δε", "φα", "γα", "κα", "κε", "λα", "λε", "μα", "με", "να", "νε", "ρα", "τα"],
}
ENDINGS = {
    "latin": {"male": "ron", "female": "ria", "given": "lin", "family": "ler"},
    "cyrillic": {"male": "рон", "female": "рия", "given": "лин", "family": "лев"},
    "greek": {"male": "ρος", "female": "ρια", "given": "λιν", "family": "λης"},
}
# The letters that stand for the sixteen hexadecimal digits, per script, and
# the rest of the alphabet, which takes turns with them.
LETTERS = {"latin": "bcdfghjklmnpqrst", "cyrillic": "бвгджзклмнпрстфх", "greek": "βγδζθκλμνξπρστφχ"}
OTHERS = {"latin": "aeiouvwxyzaeiouv", "cyrillic": "аеийоуцчшщъыьэюя", "greek": "αεηιουψωαεηιουψω"}

#: One or more forms of address, and a word that can be a name: the 's behind it is no part of it.
TITLES = r"(?:(?:" + "|".join(sorted(MALE + FEMALE + NEUTRAL, key=len, reverse=True)) + r")\.? )++"
WORD = r"\p{Lu}(?:\p{L}|['-](?!s(?!\p{L}))\p{L})+"
#: A name without a form of address.
BARE = rf"(?<![\p{{L}}\p{{N}}._%+@'-]){WORD}(?![\p{{L}}\p{{N}}@])"
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
#: Type: pattern of an entity in its surroundings, tried in this order at each place.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}_%+-][\p{L}\p{N}._%+-]*+@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "ip": rf"(?<![\p{{L}}\p{{N}}.])(?:{OCTET}\.){{3}}{OCTET}(?![\p{{L}}\p{{N}}]|\.\d)",
    "phone": r"(?<![\p{L}\p{N}+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}"
             r"|(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[.-]\d{4})(?![\p{L}\p{N}])",
    "ssn": r"(?<![\p{L}\p{N}-])\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}-])",
    "number": r"(?<![\p{L}\p{N}-])(?:\d{13,19}|\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{1,7})(?![\p{L}\p{N}])",
    "name": rf"(?<![\p{{L}}\p{{N}}]){TITLES}{WORD}(?: {WORD})?",
}
ENTITY = "|".join(PATTERNS.values())
#: A cheap test that every entity passes.
MAYBE = r"[@0-9]|" + "|".join(MALE + FEMALE + NEUTRAL)
#: Type of a whole entity, in the same order.
KINDS = {
    "email": "@", "iban": r"^[A-Z]{2}\d{2}", "ip": rf"^(?:{OCTET}\.){{3}}{OCTET}$",
    "phone": r"^\+|^\(|^\d{3}[.-]\d{3}[.-]\d{4}$", "ssn": r"^\d{3}-\d{2}-\d{4}$", "number": r"^\d", "name": r"^\p{L}",
}
# The country codes in use; no one begins another.
COUNTRY = r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
#: Tries until a replacement is given up as impossible.
TRIES = 60
#: Tries in the format of the entity, where longer replacements are allowed; every try after that adds a character.
SHAPED = 30


def _kind(entity: Column) -> Column:
    return reduce(lambda rest, k: F.when(entity.rlike(KINDS[k]), F.lit(k)).otherwise(rest), reversed(KINDS), F.lit(None).cast("string"))


def _luhn(digits: Column) -> Column:
    """Whether the last digit checks the others."""
    places = F.transform(F.reverse(F.split(digits, "")), lambda d, i: F.when(
        i % 2 == 1, d.try_cast("int") * 2 - F.when(d.try_cast("int") > 4, 9).otherwise(0)).otherwise(d.try_cast("int")))
    return F.aggregate(places, F.lit(0), lambda a, x: a + x) % 10 == 0


def _digits(entity: Column) -> Column:
    return F.regexp_replace(entity, "[^0-9]", "")


def _script(word: Column) -> Column:
    return (F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic").when(word.rlike(r"\p{IsGreek}"), "greek").otherwise("latin"))


def _keys(literals: DataFrame) -> DataFrame:
    """(literal, kind, keys): what is replaced in each entity, as (type, plain form).

    Spellings of one entity share their keys: case of an address and punctuation of a number
    do not count; a phone number keeps the plus sign before its country code. A name has a key for its family name and one for the given name,
    of kind `given` where the titles tell no gender.
    Digit groups that only look like an account number, without a valid check digit,
    have no key and stay.
    """
    e = F.col("literal")
    words = F.split(F.regexp_replace(e, f"^{TITLES}", ""), " ")
    titles = F.split(F.regexp_extract(e, f"^{TITLES}", 0), r"\.? ")

    def told(names: list[str]) -> Column:
        return F.arrays_overlap(titles, F.array(*map(F.lit, names)))

    gender = F.when(told(FEMALE), "female").when(told(MALE), "male").otherwise("given")

    def key(kind, plain):
        return F.struct(kind.alias("kind"), plain.alias("plain"))

    family = key(F.lit("family"), F.lower(F.element_at(words, -1)))
    given = key(gender, F.lower(F.element_at(words, 1)))
    kind = F.col("kind")
    grouped = e.rlike("[ -]") & ~_luhn(_digits(e))
    keys = (F.when(kind == "name", F.when(F.size(words) > 1, F.array(given, family)).otherwise(F.array(family)))
            .when(kind == "email", F.array(key(kind, F.lower(e))))
            .when(kind == "iban", F.array(key(kind, F.regexp_replace(e, " ", ""))))
            .when(kind == "ip", F.array(key(kind, e)))
            .when((kind == "phone") & e.startswith("+"), F.array(key(kind, F.concat(F.lit("+"), _digits(e)))))
            .when((kind == "number") & grouped, F.array().cast("array<struct<kind:string,plain:string>>"))
            .otherwise(F.array(key(kind, _digits(e)))))
    return literals.withColumn("kind", _kind(e)).withColumn("keys", keys)


def _gendered(literals: DataFrame) -> DataFrame:
    """(literal, type, place, kind, plain) of every key. A given name without gender takes
    that of the same name elsewhere in the corpus, male where it occurs with both."""
    keys = literals.select("literal", F.col("kind").alias("type"), F.posexplode("keys").alias("place", "key")).select("literal", "type", "place", "key.*")
    known = keys.where(F.col("kind").isin("male", "female")).groupBy("plain").agg(F.max("kind").alias("gender"), F.lit("given").alias("kind"))
    return keys.join(known, ["kind", "plain"], "left").select("literal", "type", "place", F.coalesce("gender", "kind").alias("kind"), "plain")


def _pick(name: str, choices: dict[str, Column]) -> Column:
    return reduce(lambda rest, k: F.when(F.col(name) == k, choices[k]).otherwise(rest), choices, F.lit(None).cast("string"))


def _made_up_name() -> Column:
    """Syllables, two and one more with every try, and an ending, by the script and the gender."""
    def of(script: str) -> Column:
        table = F.array(*[F.lit(x) for x in SYLLABLES[script]])
        middle = F.transform(F.sequence(F.lit(1), F.lit(2) + F.col("attempt")), lambda i: F.get(
            table, F.conv(F.substr("stream", i % 320 + 1, F.lit(1)), 16, 10).cast("int")))
        return F.concat(F.array_join(middle, ""), _pick("kind", {k: F.lit(v) for k, v in ENDINGS[script].items()}))
    return _pick("script", {s: of(s) for s in SYLLABLES})


def _shaped() -> Column:
    """The plain form with every letter and digit replaced by one of its sort. An e-mail
    address keeps its last label, an IBAN its country and check digits, a phone number its
    country code."""
    kept = F.when(F.col("kind") == "email", F.length("plain") - F.locate(".", F.reverse("plain"))).otherwise(F.length("plain"))
    begin = (F.when(F.col("kind") == "iban", 4)
             .when(F.col("kind") == "phone", F.length(F.regexp_extract("plain", COUNTRY, 0))).otherwise(0))

    def of(c: Column, i: Column) -> Column:
        at = i % 320 + 1
        coin = F.substr("stream", (i + 160) % 320 + 1, F.lit(1))
        letter = F.when(coin < "8", F.substr("letters", at, F.lit(1))).otherwise(F.substr("others", at, F.lit(1)))
        return (F.when((i < begin) | (i >= kept), c).when(c.rlike(r"\p{N}"), F.substr("numerals", at, F.lit(1)))
                .when(c.rlike(r"\p{Lu}"), F.upper(letter)).when(c.rlike(r"\p{L}"), letter).otherwise(c))

    return F.array_join(F.transform(F.split("plain", ""), of), "")


def _with_surrogates(keys: DataFrame, secret: str, longer: bool) -> DataFrame:
    """Add the replacement of (kind, plain) at the try `attempt`. With `longer`, tries from
    SHAPED on are longer than the entity: letters before an e-mail address, digits at the
    end of a number, octets of an IPv4 address."""
    more = F.greatest(F.col("attempt") - (SHAPED - 1), F.lit(0)) if longer else F.lit(0)
    seed = F.concat_ws("|", F.lit(secret), "kind", "plain", F.col("attempt").cast("string"))
    out = keys.withColumns({
        "stream": F.concat(*[F.sha2(F.concat(seed, F.lit(f"|{i}")), 256) for i in range(5)]),
        "script": _script(F.col("plain"))})
    letters, others = ({s: F.translate("stream", "0123456789abcdef", x[s]) for s in x} for x in (LETTERS, OTHERS))
    out = out.withColumns({"numerals": F.translate("stream", "abcdef", "012345"), "letters": _pick("script", letters),
                           "others": _pick("script", others)})
    added = [F.substr(c, F.lit(200), more) for c in ("letters", "numerals")]
    out = out.withColumn("shape", F.when(F.col("kind") == "email", F.concat(added[0], _shaped())).otherwise(F.concat(_shaped(), added[1])))
    octets = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3) + more), lambda i: (
        F.conv(F.substr("stream", i * 4 + 1, F.lit(4)), 16, 10).cast("int") % 254 + 1).cast("string")), ".")
    checked = F.get(F.filter(F.transform(F.sequence(F.lit(0), F.lit(9)), lambda d: F.concat(
        F.expr("substring(shape, 1, length(shape) - 1)"), d.cast("string"))), _luhn), F.lit(0))
    kind = F.col("kind")
    surrogate = (F.when(kind == "ip", octets).when(kind.isin("male", "female", "given", "family"), _made_up_name())
                 .when((kind == "number") & _luhn(F.col("plain")), checked).otherwise(F.col("shape")))
    return out.select("kind", "plain", "attempt", surrogate.alias("surrogate"))


def surrogates(keys: DataFrame, secret: str, longer: bool = False) -> DataFrame:
    """(kind, plain, surrogate) with distinct surrogates, none of which is a plain form that
    occurs itself.

    Only keys whose surrogate is taken are dealt again, the one dealt earliest keeping it. A
    format with fewer values than entities is refused, or with `longer` gets replacements
    that are longer than the entity.
    """
    originals = keys.select("kind", F.col("plain").alias("surrogate"))
    settled = None
    dealt = keys.select("kind", "plain", F.lit(0).alias("attempt"))
    for attempt in count() if longer else range(TRIES):
        dealt = staged(_with_surrogates(dealt, secret, longer), "surrogates")
        free = dealt.groupBy("kind", "surrogate").agg(F.min("plain").alias("plain")).join(originals, ["kind", "surrogate"], "left_anti")
        if settled is not None:
            free = free.join(settled, ["kind", "surrogate"], "left_anti")
        free = staged(free.select("kind", "plain", "surrogate"), "settled")
        settled = free if settled is None else settled.unionByName(free)
        again = dealt.join(free, ["kind", "plain"], "left_anti")
        if again.isEmpty():
            return settled
        dealt = again.select("kind", "plain", F.lit(attempt + 1).alias("attempt"))
    raise ValueError(f"no distinct surrogates after {TRIES} tries: a format has fewer values than entities")


def _rendered(keys: DataFrame, found: DataFrame) -> DataFrame:
    """(literal, kind, replacement): surrogates in the spelling of each entity."""
    joined = keys.join(found, ["kind", "plain"])
    parts = joined.groupBy("literal", "type").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("place", "surrogate"))), lambda x: x["surrogate"]).alias("parts"),
        (F.max(F.length("surrogate")) - F.max(F.length("plain"))).alias("more"))
    chars, core = F.split("literal", ""), F.ltrim(F.element_at("parts", 1), F.lit("+"))

    def digit(state: Column, c: Column) -> Column:
        isdigit = c.rlike("[0-9]") | ((F.col("type") == "iban") & c.rlike("[A-Z]"))
        return F.struct(
            F.concat(state["text"], F.when(isdigit, F.substr(core, state["at"], F.lit(1))).otherwise(c)).alias("text"),
            (state["at"] + isdigit.cast("int")).alias("at"))

    spelled = F.aggregate(chars, F.struct(F.lit("").alias("text"), F.lit(1).alias("at")), digit, lambda s: F.concat(s["text"], F.substr(core, s["at"])))
    cased = F.concat(F.substr(core, F.lit(1), F.col("more")), F.array_join(F.transform(chars, lambda c, i: F.when(
        c.rlike(r"\p{Lu}"), F.upper(F.substr(core, i + 1 + F.col("more"), F.lit(1)))).otherwise(F.substr(core, i + 1 + F.col("more"), F.lit(1)))), ""))
    named = F.concat(F.regexp_extract("literal", f"^{TITLES}", 0), F.array_join(F.transform("parts", F.initcap), " "))
    kind = F.col("type")
    out = parts.withColumn("replacement", (
        F.when(kind == "email", cased).when(kind == "ip", core).when(kind == "name", named).otherwise(spelled)))
    return out.select("literal", F.col("type").alias("kind"), "replacement")


def _bare_replaced(gap: Column, aliases: Column) -> Column:
    """The text between entities with the names that the same text has behind a form of
    address replaced where they stand alone: `aliases` is a map from names in lower case."""
    def shown(word: Column) -> Column:
        made = F.try_element_at(aliases, F.lower(word))
        return F.coalesce(F.when(word == F.upper(word), F.upper(made)).otherwise(made), word)

    words = F.regexp_extract_all(gap, F.lit(BARE), F.lit(0))
    pieces = F.transform(F.split(gap, BARE, -1), lambda piece, i: F.concat(piece, F.coalesce(shown(F.get(words, i)), F.lit(""))))
    return F.when(F.size(aliases) > 0, F.array_join(pieces, "")).otherwise(gap)


def _aliases(entities: Column) -> Column:
    """Map from each word of the names of a text, in lower case, to its replacement. A word
    that is a given and a family name there stands for the one that comes first."""
    def words(literal: Column) -> Column:
        return F.split(F.regexp_replace(literal, f"^{TITLES}", ""), " ")

    pairs = F.flatten(F.transform(F.filter(entities, lambda e: e["kind"] == "name"), lambda e: F.zip_with(
        words(e["literal"]), words(e["replacement"]), lambda a, b: F.struct(F.lower(a).alias("name"), b.alias("made")))))
    # One pair of each name: two passes over the distinct pairs of the text.
    distinct = F.array_distinct(pairs)
    names = F.array_distinct(F.transform(distinct, lambda p: p["name"]))
    return F.map_from_arrays(names, F.transform(names, lambda n: F.get(F.filter(distinct, lambda p: p["name"] == n), 0)["made"]))


def _count(kind: str) -> Column:
    return F.size(F.filter("_pii_all", lambda x: x["kind"] == kind))


def replace_personal_data(
    docs: DataFrame, secret: str = "pipeline", text_col: str = "text", into: str = "pii",
) -> DataFrame:
    """`docs` with surrogates in the text, and a map column `into`: entities of each type.

    Types are e-mail addresses, IBANs, IPv4 addresses, phone numbers, social security
    numbers, account or card numbers (13 to 19 digits, or groups with a valid check digit)
    and names after forms of address, which are then replaced wherever else the text has them with a
    capital letter: full, given or family name alone, before or behind. One entity has the same surrogate everywhere, in
    any spelling, and two never share one. Surrogates keep digits, letters and punctuation in their places (IPv4 addresses
    and names are made anew), the case and
    script of letters, the last label of an e-mail's domain, the country code of a phone number or
    IBAN, a valid check digit of a number, and the gender of a name. Where a format has fewer free
    values than entities, the rest get replacements that are longer.

    Texts without entities, null and empty ones included, stay as they are, with an
    empty map. Every row is treated by itself, so repeated rows and null ids do not matter. A
    column called like `into` is replaced; names beginning with `_pii_` are reserved. Only
    rows with entities are shuffled, and the entities.
    """
    text = F.col(text_col)
    found = F.when(text.rlike(MAYBE), F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0)))
    found = F.coalesce(found, F.array().cast("array<string>"))
    seen = docs.drop(into).withColumn("_pii_found", found)
    hit = staged(seen.where(F.size("_pii_found") > 0).withColumn("_pii_row", F.monotonically_increasing_id()), "pii")
    rows = hit.select("_pii_row", F.posexplode("_pii_found").alias("place", "literal"))
    literals = staged(_gendered(_keys(rows.select("literal").distinct())), "entities")
    keys = staged(literals.select("kind", "plain").distinct(), "keys")
    rendered = staged(_rendered(literals, surrogates(keys, secret, longer=True)), "rendered")
    known = rows.join(rendered, "literal", "left").select("_pii_row", F.struct(
        "place", "kind", F.coalesce("replacement", "literal").alias("replacement"), "literal").alias("one"))
    ordered = known.groupBy("_pii_row").agg(F.array_sort(F.collect_list("one")).alias("_pii_all"))
    ordered = ordered.withColumn("_pii_names", _aliases(F.col("_pii_all")))
    pieces = F.transform(F.split(text, ENTITY, -1), lambda gap, i: F.concat(
        _bare_replaced(gap, F.col("_pii_names")), F.coalesce(F.get("_pii_all", i)["replacement"], F.lit(""))))
    sizes = [x for k in KINDS for x in (F.lit(k), _count(k))]
    count = F.map_filter(F.create_map(*sizes), lambda _, n: n > 0)
    columns = docs.drop(into).columns
    replaced = hit.join(ordered, "_pii_row").select(
        *[c for c in columns if c != text_col], F.array_join(pieces, "").alias(text_col), count.alias(into))
    clean = seen.where(F.size("_pii_found") == 0).withColumn(into, F.expr("map()").cast("map<string,int>"))
    return clean.select(*columns, into).unionByName(replaced.select(*columns, into))
