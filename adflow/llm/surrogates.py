"""Surrogates for personal data: keyed, type-consistent, distinct replacements.

Entities are found by pattern: email addresses, IPv4 addresses, social security
numbers, bank account numbers (IBAN), payment cards, telephone numbers, and
persons named with a title or a well-known given name. Every distinct entity
gets one surrogate for the whole corpus, drawn by a keyed hash:

- digits stay digits and capitals capitals, letters stay in their script, and
  separators stay where they are;
- cards that pass the Luhn test still do, IBANs keep country and check sum,
  addresses get the reserved block 240.0.0.0/4, email domains the reserved
  ending ``.example``, social security numbers the unassigned area 9xx;
- a given name gets one of the same gender and script: a well-known one, or, as
  those are soon used up or entities themselves, syllables with an ending of the
  gender, more syllables with each draw; a surname gets a name of the same
  pattern of vowels and consonants; titles stay.

Mentions that only differ in case or punctuation refer to one entity and get one
surrogate in each mention's own format; a surname is replaced alike with and
without the given name, a domain alike in all addresses. Collisions are checked:
a candidate that another entity has, or that is itself an entity of the corpus,
is drawn again. After ``MOST_DRAWS`` draws the format counts as used up and the
surrogate gets longer: more syllables in a surname, a longer local part in an
email address, more digits in a number (IBANs up to their 34 characters, check
sums right), an IPv6 address of the documentation block for an IPv4 address.

Only DataFrame functions are used. Defined cases. Null and empty texts stay.
Texts without an entity stay as they are. Repeated rows each keep their row.
Long texts are rewritten whole. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adflow.llm.tables import column, fresh_name, text_of
from adflow.session import stored

MOST_DRAWS = 12
LISTED_DRAWS = 3
"""So many draws of a given name are from the lists of well-known ones."""
KEY = "surrogates"

# Titles, and well-known given names, by gender.
TITLES = {
    "m": ["Mr", "Sir", "Herr", "Monsieur", "Señor", "Sr", "Don", "господин", "г-н"],
    "f": ["Mrs", "Ms", "Miss", "Lady", "Frau", "Madame", "Mme", "Señora", "Sra", "Doña", "госпожа", "г-жа"],
    "n": ["Dr", "Prof"],
}
GIVEN = {
    "m": ["James", "John", "Robert", "Michael", "William", "David", "Thomas", "Peter", "Paul", "Hans", "Pierre", "Carlos"],
    "f": ["Mary", "Patricia", "Jennifer", "Linda", "Elizabeth", "Susan", "Anna", "Maria", "Sophie", "Ingrid", "Claire", "Carmen"],
    "n": ["Alex", "Robin", "Kim", "Sasha", "Jordan", "Taylor", "Morgan", "Casey", "Jamie", "Quinn", "Avery", "Riley"],
}
GIVEN_CYRILLIC = {
    "m": ["Иван", "Пётр", "Олег", "Борис", "Антон", "Юрий"],
    "f": ["Анна", "Мария", "Ольга", "Елена", "Нина", "Вера"],
    "n": ["Саша", "Женя", "Валя"],
}
# Alphabets by script, vowels first.
LATIN = ("aeiou", "bcdfghjklmnpqrstvwxyz")
CYRILLIC = ("аеиоуэюя", "бвгдзклмнпрстфхцчш")
GREEK = ("αεηιουω", "βγδζθκλμνξπρστφχψ")
# Endings of given names by script and gender; none ends in one of another gender.
ENDINGS = {
    LATIN: {"m": ["us", "ard", "olf", "ert"], "f": ["ina", "ia", "ette", "elle"], "n": ["yn", "is", "ey", "en"]},
    CYRILLIC: {"m": ["ор", "ан", "ислав", "имир"], "f": ["ина", "ия", "ана", "ислава"], "n": ["иша", "уня", "ася"]},
    GREEK: {"m": ["ος", "ης", "ων"], "f": ["ινα", "ουλα", "ινη"], "n": ["ι", "υ"]},
}

_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": rf"(?<![\w.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?\w)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?!-?\w)",
    "iban": r"(?<!\w)[A-Z]{2}\d{2}[A-Z0-9]{11,30}(?!\w)",
    "card": r"(?<![\w-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{5})(?!-?\w)",
    "phone": (
        r"(?<![\w.+-])(?:\+\d{1,3}[ .-]?\(?\d{1,4}\)?(?:(?:[ .-]\d{2}){4}|[ .-]?\d{3,4}[ .-]?\d{3,4})"
        r"|\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?!\w)"
    ),
}
_TITLE = "(?:" + "|".join(t for ts in TITLES.values() for t in ts) + r")\.?"
_NAME = r"\p{Lu}[\p{L}'’-]+"
_KNOWN = "(?:" + "|".join(n for g in (GIVEN, GIVEN_CYRILLIC) for ns in g.values() for n in ns) + ")"
PATTERNS["person"] = rf"(?<![\p{{L}}\d])(?:{_TITLE} {_NAME}(?: {_NAME}){{0,2}}|{_KNOWN} {_NAME})"
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
_DIGITS = ("ssn", "card", "phone")


def _draw(seed: Column, at: Column | int) -> Column:
    """A number below 2^32 from a seed and a place."""
    at = F.lit(at) if isinstance(at, int) else at
    digest = F.sha2(F.concat(seed, F.lit("#"), at.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def _one_of(choices: str | list[str], number: Column) -> Column:
    at = (number % len(choices) + 1).cast("int")
    return F.substr(F.lit(choices), at, F.lit(1)) if isinstance(choices, str) else F.element_at(F.array(*map(F.lit, choices)), at)


def _like(char: Column, number: Column, name: bool) -> Column:
    """A character of the same class: digit, or letter of the script and case; in names vowel or consonant."""
    small = F.lower(char)
    drawn = F.when(char.rlike("[0-9]"), _one_of("0123456789", number))
    for script, (vowels, others) in (
        (r"\p{IsCyrillic}", CYRILLIC),
        (r"\p{IsGreek}", GREEK),
        (r"\p{L}", LATIN),
    ):
        vowel = small.rlike(f"[{vowels}àáâãäåæèéêëìíîïòóôõöøùúûüыёїії]") if name else F.lit(False)
        if name:
            letter = F.when(vowel, _one_of(vowels, number)).otherwise(_one_of(others, number))
        else:
            letter = _one_of(vowels + others, number)
        drawn = drawn.when(char.rlike(script), F.when(char.rlike(r"\p{Lu}"), F.upper(letter)).otherwise(letter))
    return drawn.otherwise(char)


def _recast(value: Column, seed: Column, name: bool = False) -> Column:
    """The value with each letter and digit drawn anew within its class."""
    return F.array_join(F.transform(F.split(value, ""), lambda c, i: _like(c, _draw(seed, i), name)), "")


def _in_script(norm: Column, of_script) -> Column:
    """What a function of an alphabet gives for the alphabet of the name."""
    found = F.when(norm.rlike(r"\p{IsCyrillic}"), of_script(CYRILLIC)).when(norm.rlike(r"\p{IsGreek}"), of_script(GREEK))
    return found.otherwise(of_script(LATIN))


def _syllables(norm: Column, seed: Column, count: Column) -> Column:
    """So many syllables of a consonant and a vowel of the name's script."""
    pairs = _in_script(norm, lambda alphabet: F.array(*[F.lit(c + v) for c in alphabet[1] for v in alphabet[0]]))
    drawn = F.transform(F.sequence(F.lit(1), count), lambda i: (_draw(seed, i) % F.size(pairs) + 1).cast("int"))
    return F.array_join(F.transform(drawn, lambda at: F.element_at(pairs, at)), "")


def _ending(kind: Column, norm: Column, number: Column) -> Column:
    """A consonant and an ending of the given name's script and gender."""
    def of_script(alphabet: tuple[str, str]) -> Column:
        every = F.lit(None).cast("array<string>")
        for gender, endings in ENDINGS[alphabet].items():
            listed = F.array(*[F.lit(c + e) for c in alphabet[1] for e in endings])
            every = F.when(kind == f"given_{gender}", listed).otherwise(every)
        return every

    endings = _in_script(norm, of_script)
    return F.element_at(endings, (number % F.size(endings) + 1).cast("int"))


def _luhn(digits: Column) -> Column:
    """The Luhn sum of a number modulo 10, the last digit undoubled."""
    chars = F.split(F.reverse(digits), "")
    doubled = F.transform(
        chars,
        lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10


def _check_sum(iban: Column) -> Column:
    """The remainder by 97 of an IBAN's digits, country and check digits at the end."""
    moved = F.concat(F.substr(iban, F.lit(5), F.lit(40)), F.substring(iban, 1, 4))
    return F.aggregate(
        F.split(moved, ""),
        F.lit(0),
        lambda a, c: F.when(c.rlike("[0-9]"), (a * 10 + c.cast("int")) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97),
    )


def _candidate(kind: Column, norm: Column, draw: Column, key: str) -> Column:
    """The surrogate of an entity at a draw."""
    seed = F.concat_ws("|", F.lit(key), kind, norm, draw.cast("string"))
    used_up = draw >= MOST_DRAWS
    more, digest = F.concat(seed, F.lit("|more")), F.sha2(seed, 256)
    digits = F.when(used_up, F.substring(F.translate(F.sha2(more, 256), "abcdef", "012345"), 1, 24)).otherwise("")
    plain = _recast(norm, seed)
    size = F.length(norm)
    body = F.concat(F.substring(norm, 1, 1), F.substr(plain, F.lit(2), size - 2), digits)
    rest = _luhn(F.concat(body, F.lit("0")))
    card = F.when(_luhn(norm) == 0, F.concat(body, ((10 - rest) % 10).cast("string"))).otherwise(
        F.concat(body, F.substr(plain, size, F.lit(1)))
    )
    octets = [(240 + _draw(seed, 0) % 15).cast("string"), *[(_draw(seed, i) % 256).cast("string") for i in (1, 2, 3)]]
    country, account = F.substring(norm, 1, 2), F.substring(F.concat(F.substr(plain, F.lit(5), size), digits), 1, 30)
    check = 98 - _check_sum(F.concat(country, F.lit("00"), account))
    local, domain = F.substring_index(norm, "@", 1), F.substring_index(norm, "@", -1)
    first = F.regexp_replace(domain, r"\.[^.]+$", "")
    name = F.concat(_recast(local, seed), F.when(used_up, F.concat(F.lit("."), F.substring(digest, 1, 32))).otherwise(""))
    at = F.concat(name, F.lit("@"), _recast(first, F.concat(F.lit(f"{key}|domain|"), domain)), F.lit(".example"))
    found = F.when(kind == "email", at).when(kind == "card", card)
    groups = [F.substring(digest, i, 4) for i in range(1, 25, 4)]
    address = F.when(used_up, F.concat_ws(":", F.lit("2001:db8"), *groups)).otherwise(F.concat_ws(".", *octets))
    found = found.when(kind == "ip", address)
    found = found.when(kind == "ssn", F.concat(F.lit("9"), F.substr(plain, F.lit(2), size), digits))
    found = found.when(kind == "phone", F.concat(F.substring(norm, 1, 1), F.substr(plain, F.lit(2), size), digits))
    found = found.when(kind == "iban", F.concat(country, F.lpad(check.cast("string"), 2, "0"), account))
    listed = F.lit(None).cast("string")
    for gender in GIVEN:
        script = F.when(norm.rlike(r"\p{IsCyrillic}"), _one_of(GIVEN_CYRILLIC[gender], _draw(seed, 0)))
        given = script.when(norm.rlike("^[a-zß-ÿ'’-]+$"), _one_of(GIVEN[gender], _draw(seed, 0)))
        listed = F.when(kind == f"given_{gender}", given).otherwise(listed)
    named = kind.startswith("given_")
    longer = _syllables(norm, more, F.when(named, F.greatest(F.lit(2), draw - 1)).otherwise(8))
    given = F.coalesce(F.when(draw < LISTED_DRAWS, F.lower(listed)), F.concat(longer, _ending(kind, norm, _draw(more, 0))))
    name = F.concat(_recast(norm, seed, name=True), F.when(used_up, longer).otherwise(""))
    return found.when(named, given).otherwise(name)


def _kind(surface: Column) -> Column:
    kind = F.when(F.contains(surface, F.lit("@")), "email")
    for name in ("ip", "ssn", "iban", "card", "phone"):
        kind = kind.when(surface.rlike(f"^(?:{PATTERNS[name]})$"), name)
    return kind.otherwise("person")


def _parts(surface: Column, kind: Column) -> Column:
    """What of a mention is replaced: (kind, norm, piece) in order; a person has a part for each name."""
    digits = F.regexp_replace(surface, "[^0-9]", "")
    norm = F.when(kind.isin(*_DIGITS), digits).when(kind == "email", F.lower(surface)).otherwise(surface)
    whole = F.array(F.struct(kind.alias("kind"), norm.alias("norm"), surface.alias("piece")))
    title = F.regexp_extract(surface, f"^({_TITLE}) ", 1)
    bare = F.regexp_replace(title, r"\.", "")
    words = F.split(F.regexp_replace(surface, f"^{_TITLE} ", ""), " ")

    def gender(word: Column) -> Column:
        found = F.when(bare.isin(*TITLES["m"]), "m").when(bare.isin(*TITLES["f"]), "f")
        for g in ("m", "f"):
            found = found.when(word.isin(*GIVEN[g], *GIVEN_CYRILLIC[g]), g)
        return found.otherwise("n")

    names = F.transform(
        words,
        lambda w, i: F.struct(
            F.when((i == 0) & (F.size(words) > 1), F.concat(F.lit("given_"), gender(w))).otherwise("surname").alias("kind"),
            F.lower(w).alias("norm"),
            w.alias("piece"),
        ),
    )
    return F.when(kind == "person", names).otherwise(whole)


def _fitted(kind: Column, piece: Column, norm: Column, surrogate: Column) -> Column:
    """The surrogate in the mention's format."""
    filled = F.array_join(
        F.transform(
            F.split(piece, ""),
            lambda c, i: F.when(
                c.rlike("[0-9]"),
                F.substr(surrogate, F.length(F.regexp_replace(F.substr(piece, F.lit(1), i), "[^0-9]", "")) + 1, F.lit(1)),
            ).otherwise(c),
        ),
        "",
    )
    cased = F.when(piece == F.upper(piece), F.upper(surrogate)).otherwise(F.initcap(surrogate))
    surplus = F.substr(surrogate, F.length(norm) + 1, F.lit(100))
    named = kind.startswith("given_") | (kind == "surname")
    return (
        F.when(kind.isin(*_DIGITS), F.concat(filled, surplus))
        .when(named, cased)
        .when((kind == "email") & (piece == F.upper(piece)), F.upper(surrogate))
        .otherwise(surrogate)
    )


def draw_surrogates(entities: DataFrame, key: str = KEY) -> DataFrame:
    """(kind, norm, surrogate) for distinct entities (kind, norm): no two alike within a kind, none an entity itself."""
    given = F.col("kind").startswith("given_")
    spaced = entities.select("kind", "norm", F.when(given, "given").otherwise(F.col("kind")).alias("space"))
    everyone = stored(spaced, "entities")
    taken = everyone.select("space", F.col("norm").alias("surrogate")).distinct()
    pending, settled = everyone.withColumn("draw", F.lit(0)), None
    while True:
        drawn = stored(pending.withColumn("surrogate", _candidate(F.col("kind"), F.col("norm"), F.col("draw"), key)), "drawn")
        first = F.min(F.struct("kind", "norm")).alias("first")
        free = drawn.join(taken, ["space", "surrogate"], "left_anti").groupBy("space", "surrogate").agg(first)
        if settled is not None:
            free = free.join(settled, ["space", "surrogate"], "left_anti")
        won = free.select("space", "surrogate", "first.kind", "first.norm")
        settled = stored(won if settled is None else settled.unionByName(won), "settled")
        lost = drawn.join(settled, ["kind", "norm"], "left_anti")
        pending = stored(lost.select("kind", "norm", "space", (F.col("draw") + 1).alias("draw")), "pending")
        if pending.isEmpty():
            return settled.select("kind", "norm", "surrogate")


def replace_entities(docs: DataFrame, text: str = "text", key: str = KEY, count: str = "n_entities") -> DataFrame:
    """All columns with surrogates in the text, and the number of mentions that were replaced."""
    digest, found, new = fresh_name(docs, "text_digest", "mentions", "replacements")
    keyed = docs.withColumn(digest, F.sha2(text_of(docs, text), 256))
    whole = text_of(keyed, text)
    # Each text is searched once: the mentions are written out beside it.
    searched = stored(keyed.withColumn(found, F.regexp_extract_all(whole, F.lit(ANY), F.lit(0))), "searched")
    hit = F.size(found) > 0
    hits = searched.where(hit).select(F.col(digest).alias("digest"), F.col(found).alias("found"))
    hits = stored(hits.dropDuplicates(["digest"]), "hits")
    mentions = hits.select("digest", F.posexplode("found").alias("place", "surface"))
    surfaces = mentions.select("surface").distinct().withColumn("kind", _kind(F.col("surface")))
    parts = surfaces.select("surface", F.posexplode(_parts(F.col("surface"), F.col("kind"))).alias("at", "part"))
    parts = stored(parts.select("surface", "at", "part.*"), "parts")
    drawn = draw_surrogates(parts.select("kind", "norm").distinct(), key)
    fitted = parts.join(drawn, ["kind", "norm"]).select(
        "surface", "at", _fitted(F.col("kind"), F.col("piece"), F.col("norm"), F.col("surrogate")).alias("fitted")
    )
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("at", "fitted"))), lambda x: x["fitted"])
    titled = F.regexp_extract("surface", f"^({_TITLE} )", 1)
    titled = F.when(_kind(F.col("surface")) == "person", titled).otherwise("")
    texts = fitted.groupBy("surface").agg(ordered.alias("names"))
    texts = stored(texts.select("surface", F.concat(titled, F.array_join("names", " ")).alias("replacement")), "replacements")
    placed = mentions.join(texts, "surface").groupBy("digest").agg(
        F.array_sort(F.collect_list(F.struct("place", "replacement"))).alias("placed")
    )
    rewrites = stored(
        placed.select(F.col("digest").alias(digest), F.transform("placed", lambda x: x["replacement"]).alias(new)), "rewrites"
    )
    # Only texts with a mention meet their replacements; the others need no shuffle at any size.
    nothing = F.lit(None).cast(rewrites.schema[new].dataType)
    joined = searched.where(hit).join(rewrites, digest, "left").unionByName(searched.where(~hit).withColumn(new, nothing))
    gaps = F.split(column(searched, text).cast("string"), ANY, -1)
    pieces = F.zip_with(gaps, F.concat(F.col(new), F.array(F.lit(""))), lambda gap, r: F.concat(gap, r))
    written = F.when(F.col(new).isNull(), column(searched, text)).otherwise(F.array_join(pieces, ""))
    number = F.when(F.col(new).isNull(), 0).otherwise(F.size(new)).cast("long")
    return joined.select(*[written.alias(c) if c == text else column(docs, c) for c in docs.columns], number.alias(count))
