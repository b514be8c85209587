"""Operator 9 (native): surrogates for personal data.

Entities are found by one alternation of patterns; each is replaced by a
surrogate made from a keyed digest of its type and canonical form, so the same
entity gets the same surrogate everywhere (in any spelling: case of an e-mail
address, punctuation of a phone or card number, a phone number with or without
the country code 1, a surname with or without the given name) without any
lookup.  Surrogates keep type and format: letters stay letters in their case and
script, digits stay digits, punctuation, lengths, top-level domains, country
codes, card issuers, valid Luhn digits and IBAN check digits are kept, hex stays
hex; names are made of syllables of their script with an ending that fits the
gender of the title before them, a part for each part of a double name.  Names
are found after a title and degrees: initials, any number of capitalised parts,
particles between them (after a title in capitals, three parts, since all that
follows may be in capitals).  Initials move on in their alphabet; particles stay.
Where the same document mentions a part of such a name again, by itself, it gets
the same surrogate (parts of three letters or more).
Secrets are what stands after one of SECRET_WORDS and = (four characters or more)
or : (eight, or four with a digit), bare or quoted, as in JSON, after Bearer or
Basic, or begins as tokens of some services do, up to a blank, quote, comma or &.
Sixteen digits in a row are a card number if an issuer's digit leads and the
Luhn digit is valid, in groups of four they are always one.

Collision check: distinct entities are gathered (one row each, counted before
the shuffle), and those whose surrogate is that of another entity, or is itself
an entity of the data, get a further attempt, until all differ; names and
addresses get longer after WIDEN attempts, so their space grows with the data.
Only these exceptions are joined to the documents; usually there are none.

The key is the setting KEY_SETTING of the session; without one a key that anyone
can read is used, and a warning given.

All of it is DataFrame functions: no Python runs on the executors.  A text is
scanned once a pass: what the patterns find is cut out by one replacement.

Defined results: null text stays null and empty text empty; texts of any length
are scanned whole; all other columns pass through, whatever their names; a
repeated row is replaced alike; an empty table gives an empty result; a type
whose format has fewer members than the data (addresses of four bytes, say) is
an error.
"""

from __future__ import annotations

import uuid
import warnings
from collections.abc import Callable
from hashlib import sha256

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import staged, table

KEY_SETTING = "spark.loomline.surrogateKey"
#: Only where none is set, as in tests: surrogates made with it can be traced back.
OPEN_KEY = "surrogate-key-1"
ROUNDS = 40
#: Attempts after which names and addresses get longer, each time.
WIDEN = 6
#: Stands between pieces of a text; texts that hold it are cut in another way.
MARK = "\x01"
LONG = 128
BROADCAST_ROWS = 100_000
#: Parts of a name without a surrogate of their own: particles, which stay, and initials, which are moved on in the alphabet.
UNTOLD = ["kept", "initial"]

#: Titles before names, by gender, and what names are made of, by script.
MALE = "Mr|Herr|Señor|Sr|Monsieur|господин"
FEMALE = "Mrs|Ms|Miss|Frau|Señora|Sra|Madame|Mme|госпожа"
SYLLABLES = {"latin": ("bdfgklmnprstvz", "aeiou"), "cyrillic": ("бвгдзклмнпрст", "аеиоу")}
ENDINGS = {
    ("latin", "given", "m"): ["n", "r", "s", "k"], ("latin", "given", "f"): ["la", "na", "ra", "ta"], ("latin", "surname", ""): ["son", "man", "field", "er"],
    ("cyrillic", "given", "m"): ["н", "р", "м", "л"], ("cyrillic", "given", "f"): ["на", "ра", "ла", "та"], ("cyrillic", "surname", "m"): ["ов", "ин", "ев", "ский"], ("cyrillic", "surname", "f"): ["ова", "ина", "ева", "ская"],
}

LOUD_MALE = "MR|HERR|SEÑOR|MONSIEUR|ГОСПОДИН"
LOUD_FEMALE = "MRS|FRAU|SEÑORA|MADAME|MME|ГОСПОЖА"
DEGREES = "Dr|Prof|Dipl|Ing|Mag|Lic|Rev|Hon"
PARTICLES = "de|del|la|las|los|da|das|do|dos|di|du|des|van|der|den|von|zu|ten|ter|le|el|al|bin|ibn|y|e"
#: Words before a secret, and what tokens of some services begin with.
SECRET_WORDS = "passwords?|passwd|pwd|token|secret|api[_-]?key"
SERVICES = "sk-|rk-|gh[opsu]_|github_pat_|glpat-|xox[abpr]-|AIza|hf_"

TITLE = rf"(?:(?:{MALE}|{FEMALE})\.? (?:(?:{DEGREES})\.? )*+|(?:{LOUD_MALE}|{LOUD_FEMALE})\.? )"
INITIAL = r"\p{Lu}\.(?= )"
NAME = r"\p{Lu}(?:\p{L}|['’](?!s\b)\p{L})*+(?:-\p{L}(?:\p{L}|['’](?!s\b)\p{L})*+)*+"
OCTET = r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
LOCAL, LABEL = r"[\p{L}\p{N}._%+-]", r"[\p{L}\p{N}-]"
GROUP = "[0-9A-Fa-f]{1,4}"
#: Characters of a secret, and those that end a sentence or a bracket rather than it.
CHAR, AFTER = r"[^\s\"'<>,;&]", r"(?<![.!?:)\]}])"
PATTERNS = {
    "email": rf"(?<!{LOCAL}){LOCAL}++@[\p{{L}}\p{{N}}](?:{LABEL}{{0,62}}\.){{1,8}}\p{{L}}{{2,24}}\b",
    "key": r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b",
    "secret": (
        rf"""(?<=[= "'])(?<=(?i:{SECRET_WORDS})["']? {{0,2}}= {{0,2}}["']?)(?!=){CHAR}{{4,}}{AFTER}"""
        rf"""|(?<=[: "'])(?<=(?i:{SECRET_WORDS})["']? {{0,2}}: {{0,2}}["']?)(?:(?=[^\s\"'<>,;&0-9]*+[0-9]){CHAR}{{4,}}|{CHAR}{{8,}}){AFTER}"""
        rf"|(?<=(?i:bearer) {{1,2}})(?=[^\s0-9]*+[0-9])[A-Za-z0-9+/_.=~-]{{8,}}{AFTER}|(?<=(?i:authorization: {{0,2}}basic) {{1,2}})[A-Za-z0-9+/=]{{4,}}"
        rf"|\b(?:{SERVICES})[A-Za-z0-9_-]{{16,}}"
    ),
    "iban": r"\b[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z])",
    "card": r"(?<![0-9.])(?:[2-6][0-9]{15}|[0-9]{4}(?:[ -][0-9]{4}){3}|3[47][0-9]{2}[ -]?[0-9]{6}[ -]?[0-9]{5})(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])|(?<=(?i:ssn)[:#]? {0,2})[0-9]{9}(?![0-9])",
    "phone": r"\+[0-9](?:[ .()/-]{0,2}[0-9]){7,14}(?![0-9])|\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}(?![0-9])|(?<![0-9-])[0-9]{3}-[0-9]{3}-[0-9]{4}(?![0-9-])|(?<![0-9.,:/-])0[1-9][0-9]{1,3}[ /-][0-9]{3,4}[ -][0-9]{3,5}(?![0-9.:/-]?[0-9])",
    "ip": rf"(?<![0-9.]){OCTET}(?:\.{OCTET}){{3}}(?![0-9]|\.[0-9])",
    "ip6": rf"(?<![0-9A-Za-z:])(?=[0-9A-Fa-f:]{{0,38}}[0-9])(?:(?:{GROUP}:){{7}}{GROUP}|(?:{GROUP}:){{1,6}}(?::{GROUP}){{1,6}}|::{GROUP}(?::{GROUP}){{1,6}})(?![0-9A-Za-z:]|\.[0-9])",
    "name": rf"\b(?:(?:{LOUD_MALE}|{LOUD_FEMALE})\.? {NAME}(?: {NAME}){{0,2}}|{TITLE}(?:{INITIAL} )*+{NAME}(?: (?:(?:{PARTICLES}) )*+(?:{INITIAL}|{NAME}))*+)",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: What every text with an entity has; titles are only tried where one of their first letters stands.
TITLES = f"{MALE}|{FEMALE}|{LOUD_MALE}|{LOUD_FEMALE}"
QUICK = rf"[0-9@=:]|A(?:KIA|SIA)|\b(?:{SERVICES})|(?=[{''.join(sorted({title[0] for title in TITLES.split('|')}))}])(?:{TITLES})\.? \p{{Lu}}"
#: Country codes of telephone numbers of one and two digits; all others have three.
COUNTRY = "1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once."""
    return F.transform(F.array(value), body)[0]


def _chars(text: Column, body: Callable[[Column, Column], Column]) -> Column:
    """Each character of text replaced by body(character, its 1-based place)."""
    return F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1))), lambda i: body(F.substring(text, i, F.lit(1)), i)), "")


def digest(kind: Column, canon: Column, attempt: Column, key: str) -> Column:
    """Keyed hex digits, four for each character of canon and 64 at least."""
    blocks = F.sequence(F.lit(0), F.floor(F.length(canon) / 16).cast("int"))
    # a long canon is hashed once, not once a block
    name = F.when(F.length(canon) > LONG, F.sha2(canon, 256)).otherwise(canon)
    return F.array_join(F.transform(blocks, lambda b: F.sha2(F.concat_ws("\x1f", F.lit(key), kind, name, attempt.cast("string"), b.cast("string")), 256)), "")


def _pieces(text: Column, hexed: Column, body: Callable[[Column, Column], Column]) -> Column:
    """body(text, hexed) of LONG characters at a time: characters of a long string are slow to reach."""
    piece = lambda p: let(F.substring(text, p * LONG + 1, F.lit(LONG)), lambda t: let(F.substring(hexed, p * LONG * 4 + 1, F.lit(LONG * 4)), lambda h: body(t, h)))
    return F.array_join(F.transform(F.sequence(F.lit(0), F.floor((F.length(text) - 1) / LONG).cast("int")), piece), "")


def _draw(hexed: Column, place: Column, below: int | Column) -> Column:
    """A number from 0 to below - 1 from the place-th (1-based) four hex digits."""
    return F.conv(F.substring(hexed, (place - 1) * 4 + 1, F.lit(4)), 16, 10).cast("int") % below


def _pick(letters: str, hexed: Column, place: Column) -> Column:
    return F.substring(F.lit(letters), _draw(hexed, place, len(letters)) + 1, F.lit(1))


def _spelled(sets: tuple[str, ...], hexed: Column, first: int, count: int) -> Column:
    """Letters drawn from the sets in turn, from this place of the digits on."""
    drawn = lambda i, letters: F.substring(letters, _draw(hexed, i + first, F.length(letters)) + 1, F.lit(1))
    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda i: let(F.get(F.array(*map(F.lit, sets)), i % len(sets)), lambda letters: drawn(i, letters))), "")


def _alike(text: Column, hexed: Column) -> Column:
    """Digits for digits, letters for letters of their case and script, the rest as it is."""
    kinds = {"[0-9]": "0123456789", "[a-z]": "abcdefghijklmnopqrstuvwxyz", "[A-Z]": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "[а-яё]": "абвгдежзиклмнопрстуфхцчшэюя", "[А-ЯЁ]": "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ"}
    kinds |= {r"\p{Lu}": kinds["[A-Z]"], r"\p{L}": kinds["[a-z]"], r"\p{N}": kinds["[0-9]"]}

    def other(c: Column, i: Column) -> Column:
        letters = F
        for pattern, known in kinds.items():
            letters = letters.when(c.rlike(pattern), F.lit(known))
        return let(letters, lambda known: F.when(known.isNull(), c).otherwise(F.substring(known, _draw(hexed, i, F.length(known)) + 1, F.lit(1))))

    return _chars(text, other)


def _hex_alike(text: Column, hexed: Column) -> Column:
    return _chars(text, lambda c, i: F.when(c.rlike("[0-9a-f]"), _pick("0123456789abcdef", hexed, i)).otherwise(c))


def _mod97(text: Column) -> Column:
    """Remainder of the number that letters as 10 to 35 and digits spell."""
    values = F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: F.conv(F.substring(text, i, F.lit(1)), 36, 10).cast("int"))
    return F.aggregate(values, F.lit(0), lambda a, x: (a * F.when(x > 9, 100).otherwise(10) + x) % 97)


def _luhn(digits: Column, odd: int) -> Column:
    """Luhn sum; the digit that is odd-th from the right (0: the second) is the first doubled."""
    n = F.length(digits)
    twice = lambda d: F.when(d * 2 > 9, d * 2 - 9).otherwise(d * 2)
    values = F.transform(F.sequence(F.lit(1), n), lambda i: let(F.substring(digits, n - i + 1, F.lit(1)).cast("int"), lambda d: F.when(i % 2 == odd, twice(d)).otherwise(d)))
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


def is_name(kind: Column) -> Column:
    return kind.startswith("given") | kind.startswith("surname")


def canonical(kind: Column, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    phone = F.when(value.startswith("+") | value.startswith("0"), digits).otherwise(F.concat(F.lit("1"), digits))
    return F.when(kind == "phone", phone).when(kind.isin("card", "ssn"), digits).when(kind == "iban", F.regexp_replace(value, " ", "")).when(kind.isin("email", "ip6") | is_name(kind), F.lower(value)).otherwise(value)


def surrogate(kind: Column, canon: Column, hexed: Column, wider: Column) -> Column:
    """Canonical surrogate of a canonical entity; names and addresses are longer by `wider` steps."""
    n = F.length(canon)
    letters = lambda first, count: _spelled(("abcdefghijklmnopqrstuvwxyz",), hexed, first, count)
    numbers = lambda first, count: _spelled(("0123456789",), hexed, first, count)
    from_second = lambda first: F.substring(canon, first, n)
    head = F.substring(canon, F.lit(1), n - F.length(F.substring_index(canon, ".", -1)))
    code = F.regexp_extract(canon, f"^(?:{COUNTRY}|[0-9]{{3}})", 0)
    # what changes letter by letter, of all kinds at once
    varied = (
        F.when(kind == "email", head).when(kind.isin("key", "iban"), from_second(F.lit(5))).when(kind == "card", F.substring(canon, F.lit(2), n - 2))
        .when(kind == "phone", from_second(F.length(code) + 2)).when(kind == "ssn", canon).otherwise("")
    )
    return let(_alike(varied, hexed), lambda body: _surrogate(kind, canon, hexed, wider, code, body, letters, numbers))


def _surrogate(kind: Column, canon: Column, hexed: Column, wider: Column, code: Column, varied: Column, letters: Callable, numbers: Callable) -> Column:
    """As surrogate(); varied is what changes letter by letter, already changed."""
    longer = F.when(wider > 1, letters(1, 12)).when(wider > 0, letters(1, 4)).otherwise(F.lit(""))
    email = F.concat(longer, varied, F.substring_index(canon, ".", -1))
    hexadecimal = lambda t, h: _chars(t, lambda c, i: _pick("0123456789abcdef", h, i))
    secret = _pieces(canon, hexed, lambda t, h: F.when(canon.rlike("^[0-9a-f]+$"), hexadecimal(t, h)).otherwise(_alike(t, h)))
    card = let(
        F.concat(F.substring(canon, 1, 1), varied),
        lambda body: let((F.lit(10) - _luhn(body, 1) % 10) % 10, lambda d: F.concat(body, F.when(_luhn(canon, 0) % 10 == 0, d).otherwise((d + 1 + _draw(hexed, F.lit(16), 9)) % 10).cast("string"))),
    )
    first = lambda place: _pick("23456789", hexed, F.lit(place))
    american = F.concat(F.lit("1"), first(1), numbers(2, 2), F.when(F.substring(canon, 5, 3) == "555", F.lit("555")).otherwise(F.concat(first(4), numbers(5, 2))), numbers(7, 4))
    # a first digit that is not 0 stays one: a leading 0 would be a trunk prefix
    abroad = F.concat(code, F.when(F.substring(canon, F.length(code) + 1, F.lit(1)) == "0", F.lit("0")).otherwise(_pick("123456789", hexed, F.lit(16))), varied)
    phone = F.when(canon.rlike("^1[0-9]{10}$"), american).otherwise(abroad)
    iban = F.concat(F.substring(canon, 1, 2), F.lpad((98 - _mod97(F.concat(varied, F.substring(canon, 1, 2), F.lit("00")))).cast("string"), 2, "0"), varied)
    octets = F.transform(F.sequence(F.lit(1), F.lit(4)), lambda i: let(F.when(i.isin(1, 4), 254).otherwise(256), lambda below: (_draw(hexed, i, below) + F.when(below == 254, 1).otherwise(0)).cast("string")))
    ip6 = _hex_alike(F.when(wider > 0, F.lit(":".join(["0000"] * 8))).otherwise(canon), F.concat(hexed, F.sha2(hexed, 512)))
    out = F.when(kind == "email", email).when(kind == "key", F.concat(F.substring(canon, 1, 4), varied)).when(kind == "secret", secret).when(kind == "card", card).when(kind == "phone", phone)
    out = out.when(kind == "ssn", varied).when(kind == "iban", iban).when(kind == "ip", F.array_join(octets, ".")).when(kind == "ip6", ip6)

    def name(script: str) -> Column:
        pairs = lambda first, count: _spelled(SYLLABLES[script], hexed, first, 2 * count)
        more = F.when(wider > 1, pairs(8, 4)).when(wider > 0, pairs(8, 2)).otherwise(F.lit(""))
        ending = F
        for (of, part, gender), endings in ENDINGS.items():
            if of == script:
                ending = ending.when(kind == f"{part}_{script}_{gender}", F.array(*map(F.lit, endings)))
        return F.concat(pairs(1, 3), more, let(ending, lambda e: F.get(e, _draw(hexed, F.lit(7), F.size(e)))))

    for script in SYLLABLES:
        out = out.when(kind.contains(f"_{script}_"), name(script))
    return out


def rendered(kind: Column, value: Column, fake: Column) -> Column:
    """The canonical surrogate in the spelling of value."""
    plain = F.regexp_replace(value, "[^0-9A-Z]", "")
    # from the right, so that a country code that value does not spell is left out
    place = lambda i: F.length(F.regexp_replace(F.substring(value, F.lit(1), i), "[^0-9A-Z]", "")) + F.length(fake) - F.length(plain)
    placed = _chars(value, lambda c, i: F.when(c.rlike("[0-9A-Z]"), F.substring(fake, place(i), F.lit(1))).otherwise(c))
    # what a longer surrogate has more stands first, in small letters
    cased = _chars(fake, lambda c, i: F.when(F.substring(value, F.greatest(i - F.length(fake) + F.length(value), F.lit(0)), F.lit(1)).rlike(r"\p{Lu}"), F.upper(c)).otherwise(c))
    loud = (value == F.upper(value)) & (F.length(value) > 1)
    return F.when(kind.isin("card", "phone", "ssn", "iban"), placed).when(kind.isin("email", "ip6") & (F.length(fake) >= F.length(value)), cased).when(is_name(kind), F.when(loud, F.upper(fake)).otherwise(F.initcap(fake))).otherwise(fake)


def kind_of(entity: Column) -> Column:
    """The type of what the patterns found; null for digits that are no card number."""
    plain = lambda name: entity.rlike(f"^(?:{PATTERNS[name]})$")
    return (
        F.when(entity.contains("@") & plain("email"), "email").when(plain("key"), "key").when(entity.rlike(f"^{TITLE}"), "name").when(plain("ip"), "ip")
        .when(entity.rlike("^[0-9]{16}$"), F.when((_luhn(entity, 0) % 10 == 0), "card")).when(plain("card"), "card").when(entity.rlike("^(?:[0-9]{3}-[0-9]{2}-[0-9]{4}|[0-9]{9})$"), "ssn").when(plain("phone"), "phone")
        .when(plain("iban"), "iban").when(plain("ip6"), "ip6").otherwise("secret")
    )


def entity(found: Column) -> Column:
    """Prefix (a title), and parts (kind, value, canon, after) that are replaced one by one; none of what is no entity."""

    def by_kind(kind: Column) -> Column:
        prefix = F.when(kind == "name", F.regexp_extract(found, f"^{TITLE}", 0)).when(kind == "secret", F.regexp_extract(found, f"^(?:{SERVICES})", 0)).when(kind.isNull(), found).otherwise(F.lit(""))
        script = F.when(found.rlike(r"\p{IsCyrillic}$"), "cyrillic").otherwise("latin")
        gender = F.when(found.rlike(rf"^(?:{MALE}|{LOUD_MALE})\.? "), "m").otherwise("f")
        names = F.split(F.regexp_replace(found, f"^{TITLE}", ""), " ")

        def pieces_of(words: Column) -> Column:
            proper = F.filter(F.transform(words, lambda w, i: F.when(w.rlike(rf"^\p{{Lu}}(?!\.$)") & ~w.rlike(rf"^(?:{PARTICLES})$"), i)), lambda i: i.isNotNull())

            def piece(name: Column, i: Column, first: Column) -> Column:
                given = (F.size(first) > 1) & (i == first[0])
                named = F.when(given, F.concat(F.lit("given_"), script, F.lit("_"), gender)).otherwise(F.concat(F.lit("surname_"), script, F.lit("_"), F.when(script == "cyrillic", gender).otherwise(F.lit(""))))
                kind_ = F.when(name.rlike(r"^\p{Lu}\.$"), "initial").when(~name.rlike(r"^\p{Lu}"), "kept").otherwise(named)
                halves = F.when(kind_ == "initial", F.array(name)).otherwise(F.split(name, "-"))
                return let(kind_, lambda k: F.transform(halves, lambda w, j: F.struct(k.alias("kind"), w.alias("value"), F.lower(w).alias("canon"), F.when(j < F.size(halves) - 1, "-").when(i < F.size(words) - 1, " ").otherwise("").alias("after"))))

            return let(proper, lambda first: F.flatten(F.transform(words, lambda name, i: piece(name, i, first))))

        body = F.substring(found, F.length(prefix) + 1, F.length(found))
        one = F.array(F.struct(kind.alias("kind"), body.alias("value"), canonical(kind, body).alias("canon"), F.lit("").alias("after")))
        return F.struct(prefix.alias("prefix"), F.when(kind == "name", let(names, pieces_of)).when(kind.isNull(), F.slice(one, 1, 0)).otherwise(one).alias("parts"))

    return let(kind_of(found), by_kind)


def pieces(text: Column) -> Column:
    """text cut into what is no entity and what is, in turns, beginning and ending with the former; null if it has none."""
    fast = F.split(F.regexp_replace(text, ANY, f"{MARK}$0{MARK}"), MARK, -1)
    both = F.flatten(F.zip_with(F.split(text, ANY, -1), F.concat(F.regexp_extract_all(text, F.lit(ANY), F.lit(0)), F.array(F.lit(""))), lambda a, b: F.array(a, b)))
    return F.when(text.rlike(QUICK), F.when(text.contains(MARK), F.slice(both, F.lit(1), F.size(both) - 1)).otherwise(fast))


def entities(cut: Column) -> Column:
    """Entities of the pieces of a text, in order."""
    return F.when(F.size(cut) > 1, F.transform(F.sequence(F.lit(1), F.size(cut) - 2, F.lit(2)), lambda i: entity(cut[i])))


def has_entity(text: Column) -> Column:
    """Whether anything of text would be replaced."""
    return F.coalesce(F.exists(entities(pieces(text)), lambda e: F.size(e["parts"]) > 0), F.lit(False))


def attempts(units: DataFrame, key: str, rounds: int = ROUNDS) -> DataFrame:
    """(kind, canon, attempt) of the entities whose first surrogate collides."""
    real = staged(units.distinct())
    fake = lambda df: df.withColumn("fake", let(digest(F.col("kind"), F.col("canon"), F.col("attempt"), key), lambda h: surrogate(F.col("kind"), F.col("canon"), h, F.floor(F.col("attempt") / WIDEN))))
    given = fake(real.withColumn("attempt", F.lit(0)))
    for _ in range(rounds):
        rank = F.row_number().over(Window.partitionBy("kind", "fake").orderBy("attempt", "canon"))
        taken = real.select(F.col("kind"), F.col("canon").alias("fake"), F.lit(True).alias("real"))
        judged = staged(given.join(taken, ["kind", "fake"], "left").withColumn("bad", F.coalesce("real", F.lit(False)) | (rank > 1)))
        if not judged.where("bad").limit(1).count():
            return judged.where("attempt > 0").select("kind", "canon", "attempt")
        given = fake(judged.select("kind", "canon", (F.col("attempt") + F.col("bad").cast("int")).alias("attempt")))
    raise ValueError("an entity type has more members than its surrogate format can tell apart")


def rotated(value: Column, key: str) -> Column:
    """An initial moved on in its alphabet, by a number of steps that the key gives: never itself, no two alike."""
    out = value
    for name, letters in (("latin", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), ("cyrillic", "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ")):
        by = 1 + int(sha256(f"{key}\x1finitial\x1f{name}".encode()).hexdigest(), 16) % (len(letters) - 1)
        out = F.translate(out, letters, letters[by:] + letters[:by])
    return out


def secret_key(spark: SparkSession) -> str:
    key = spark.conf.get(KEY_SETTING, None)
    if not key:
        warnings.warn(f"{KEY_SETTING} is not set: surrogates are made with a key that anyone can read", stacklevel=2)
    return key or OPEN_KEY


def replace_entities(docs: DataFrame, key: str | None = None, counted: str | None = None) -> DataFrame:
    """docs with surrogates in text; counted names a column for the number of entities replaced."""
    key = key or secret_key(docs.sparkSession)
    # generated, so that no filter or projection has the texts cut again
    cuts = docs.select(F.xxhash64("text").alias("_text"), F.explode(F.array(pieces(F.col("text")))).alias("_cut")).where(F.size("_cut") > 1)
    parts = F.flatten(F.transform(entities(F.col("_cut")), lambda e: e["parts"]))
    found = staged(cuts.select("_text", F.explode(F.array(parts)).alias("_parts")).select("_text", F.explode("_parts").alias("p")).select("_text", "p.kind", "p.canon").where(~F.col("kind").isin(UNTOLD)))
    again = staged(attempts(found.select("kind", "canon"), key))
    few = again.count()
    mark = uuid.uuid4().hex  # clash with no column
    cut, old, new, tries = (f"_{name}_{mark}" for name in ("cut", "old", "new", "tries"))
    work = docs.select("*", F.explode(F.array(pieces(F.col("text")))).alias(cut))
    if few:
        mine = found.join(F.broadcast(again) if few <= BROADCAST_ROWS else again, ["kind", "canon"]).groupBy("_text").agg(F.map_from_entries(F.collect_set(F.struct(F.concat_ws("\x1f", "kind", "canon"), "attempt"))).alias(tries))
        mine = staged(mine.withColumnRenamed("_text", f"_text_{mark}"))
        work = work.join(F.broadcast(mine) if mine.count() <= BROADCAST_ROWS else mine, F.xxhash64(work["text"]) == mine[f"_text_{mark}"], "left").drop(f"_text_{mark}")
    attempt = (lambda p: F.coalesce(F.try_element_at(F.col(tries), F.concat_ws("\x1f", p["kind"], p["canon"])), F.lit(0))) if few else lambda p: F.lit(0)

    def shown(p: Column) -> Column:
        told = let(attempt(p), lambda n: let(digest(p["kind"], p["canon"], n, key), lambda h: let(surrogate(p["kind"], p["canon"], h, F.floor(n / WIDEN)), lambda f: rendered(p["kind"], p["value"], f))))
        return F.when(p["kind"] == "kept", p["value"]).when(p["kind"] == "initial", rotated(p["value"], key)).otherwise(told)

    def replaced(e: Column) -> Column:
        return F.struct(e["prefix"].alias("prefix"), F.transform(e["parts"], lambda p: F.struct(p["kind"].alias("kind"), p["value"].alias("value"), p["after"].alias("after"), shown(p).alias("shown"))).alias("parts"))

    work = work.select("*", F.explode(F.array(F.transform(entities(F.col(cut)), replaced))).alias(old))
    # parts of names, for later mentions of them by themselves
    named = F.array_distinct(F.transform(F.filter(F.flatten(F.transform(F.col(old), lambda e: e["parts"])), lambda p: is_name(p["kind"]) & (F.length(p["value"]) > 2)), lambda p: F.struct(p["value"].alias("value"), p["shown"].alias("shown"))))
    work = work.withColumn(new, named)
    bound = lambda name: F.concat(F.lit(r"(?<![\p{L}\p{N}])"), name, F.lit(r"(?![\p{L}\p{N}])"))
    rest = lambda t: F.aggregate(F.col(new), t, lambda a, n: F.when(F.contains(a, n["value"]), F.regexp_replace(a, bound(n["value"]), n["shown"])).otherwise(a))
    between = F.transform(F.sequence(F.lit(0), F.size(cut) - 1, F.lit(2)), lambda i: rest(F.col(cut)[i]))
    ents = F.transform(F.col(old), lambda e: F.concat(e["prefix"], F.array_join(F.transform(e["parts"], lambda p: F.concat(p["shown"], p["after"])), "")))
    whole = F.array_join(F.flatten(F.zip_with(between, F.concat(ents, F.array(F.lit(""))), lambda a, b: F.array(a, b))), "")
    columns = [F.when(F.size(cut) > 1, whole).otherwise(F.col(c)).alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    extra = [F.when(F.size(cut) > 1, F.size(F.filter(F.col(old), lambda e: F.size(e["parts"]) > 0))).otherwise(0).cast("long").alias(counted)] if counted else []
    return work.select(*columns, *extra)


def op9_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_entities(table(spark, sf_dir, "documents").select("doc_id", "text"), counted="n_replaced")
