"""Surrogates for personal data (operator 3); DataFrame functions only.

Entities are found by one pattern. Every distinct entity of the table gets one surrogate of its own type and format:
length, separators, letter case, script and alphabet of every character stay (but the numbers of an address may have
other lengths), as do a private address range, a country prefix, a top-level domain, and the validity of check digits. Characters of such an entity are permuted together by a
keyed Feistel network over its alphabets, so different entities get different surrogates by construction. A surrogate
that equals an entity of the table, or one of an earlier draw, is drawn again under another tweak. What still collides
after DRAWS draws (formats whose space is nearly used up) is finished exactly: within a format the entities left over
take each other's values in a circle, values that are replaced themselves wherever they stand; an entity alone in a
format that leaves no other value becomes a marked code.

A person is a chain of titles, then initials, particles and any names, the last one the surname. Given names are drawn
for the gender of the titles and the script, surnames for the script, in the length and case of the original; both
grow by a syllable with each draw. Names are told apart without regard to case, so SMITH and Smith stay one surname;
so are mail addresses. Equal entities get equal surrogates in all texts.

Defined results: null texts stay null, texts without entities stay as they are; repeated rows are repeated; rows that
share an id are told apart by their texts; very long texts are handled whole; all columns of the input are kept whatever
their names, but one called pii_kinds is replaced; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import discard, table, unused, written

#: Draws before the exact way, rounds of the network.
DRAWS, ROUNDS = 6, 4
#: Uses that make an entity frequent, and ways into which the rows of a frequent one are dealt.
FREQUENT, SALTS = 100_000, 16
TITLES = {"m": ["Mr", "Herr", "Monsieur", "Señor", "Signor", "Господин", "Κύριος"], "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Señora", "Signora", "Госпожа", "Κυρία"], "n": ["Dr", "Prof"]}
PARTICLES = ["af", "al", "bin", "da", "de", "del", "della", "den", "der", "di", "dos", "du", "el", "ibn", "la", "le", "ter", "van", "von", "zu"]
GIVEN = {
    ("m", "Latn"): ["Adrian", "Bruno", "Carl", "Daniel", "Emil", "Felix", "Hugo", "Jonas", "Leon", "Martin", "Oscar", "Samuel"],
    ("f", "Latn"): ["Alma", "Berta", "Clara", "Diana", "Elena", "Flora", "Helena", "Julia", "Laura", "Marta", "Nora", "Sara"],
    ("n", "Latn"): ["Alex", "Andrea", "Charlie", "Dominique", "Kim", "Mika", "Noa", "Robin", "Sam", "Toni", "Valery", "Yuri"],
    ("m", "Cyrl"): ["Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Кирилл", "Лев", "Максим", "Олег", "Павел"],
    ("f", "Cyrl"): ["Алла", "Вера", "Галина", "Дарья", "Елена", "Зоя", "Инна", "Лидия", "Мария", "Нина", "Ольга", "Раиса"],
    ("n", "Cyrl"): ["Валя", "Женя", "Саша", "Шура", "Слава", "Паша", "Никита", "Миша", "Юля", "Тоня", "Лёша", "Даня"],
    ("m", "Grek"): ["Ανδρέας", "Γιώργος", "Δημήτρης", "Ηλίας", "Κώστας", "Λουκάς", "Νίκος", "Πέτρος"],
    ("f", "Grek"): ["Άννα", "Δάφνη", "Ελένη", "Ζωή", "Κατερίνα", "Μαρία", "Σοφία", "Χρυσάνθη"],
    ("n", "Grek"): ["Αλέξης", "Γεσθημανή", "Θεανώ", "Κλειώ", "Μυρτώ", "Φανή", "Χαρά", "Ωραιοζήλη"],
}
SYLLABLES = {
    "Latn": ["ba", "del", "for", "gan", "hol", "kir", "lan", "mor", "nev", "par", "ros", "sel", "tan", "ver", "wil", "zor"],
    "Cyrl": ["ба", "вел", "гор", "дан", "жил", "зор", "кир", "лан", "мор", "нев", "пар", "рос", "сел", "тан", "фед", "чер"],
    "Grek": ["βα", "γερ", "διν", "ζαν", "θεο", "κορ", "λαμ", "μιρ", "νεκ", "παλ", "ραν", "σιδ", "ταλ", "φερ", "χαν", "ψαρ"],
}
SCRIPTS = {"Cyrl": "Cyrillic", "Grek": "Greek"}
ALL_TITLES = [x for ts in TITLES.values() for t in ts for x in (t, t.upper())]
_T = "|".join(ALL_TITLES)
INITIALS = r"(?:\p{Lu}\.){1,3}"
NAME = rf"(?!(?:{_T})(?![\p{{L}}]))\p{{Lu}}[\p{{L}}'’-]{{1,40}}"
PERSON = rf"(?<![\p{{L}}])(?:(?:{_T})\.? )+(?:(?:{INITIALS}|(?:{'|'.join(PARTICLES)})(?![\p{{L}}])|{NAME}) ){{0,8}}{NAME}"
#: Kind and pattern, the first that fits wins.
KINDS = [
    ("email", r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,64}+@(?:[\p{L}\p{N}-]{1,63}\.){1,8}\p{L}{2,24}(?![\p{L}\p{N}])"),
    ("secret", r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-(?=(?:[_-]*[A-Za-z0-9]){8})[A-Za-z0-9_-]{20,100}|[0-9A-Fa-f]{32,128})(?![A-Za-z0-9])"),
    ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    ("ip", r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?![0-9]|\.[0-9])"),
    ("card", r"(?<![0-9])(?:[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}|3[47][0-9]{2}[ -]?[0-9]{6}[ -]?[0-9]{5})(?![0-9])"),
    ("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    ("phone", r"(?<![0-9+])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){1,4}|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?![0-9])"),
    ("person", PERSON),
]
ENTITY = "|".join(f"(?:{p})" for _, p in KINDS)
#: Without a digit, an at sign or one of these a text can't hold an entity.
HINTS = ["sk-", "AKIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", *ALL_TITLES]
#: Alphabets: first and last code point and step; a character is replaced by one of its own alphabet.
ALPHABETS = [
    (0x30, 0x39, 1), (0x61, 0x7A, 1), (0x41, 0x5A, 1), (0xC0, 0xD6, 1), (0xD8, 0xDE, 1), (0xE0, 0xF6, 1), (0xF8, 0xFF, 1),
    (0x100, 0x136, 2), (0x101, 0x137, 2), (0x139, 0x147, 2), (0x13A, 0x148, 2), (0x14A, 0x176, 2), (0x14B, 0x177, 2), (0x179, 0x17D, 2), (0x17A, 0x17E, 2),
    (0x391, 0x3A1, 1), (0x3A3, 0x3A9, 1), (0x3AC, 0x3AF, 1), (0x3B1, 0x3C9, 1), (0x3CC, 0x3CE, 1),
    (0x410, 0x42F, 1), (0x430, 0x44F, 1), (0x400, 0x40F, 1), (0x450, 0x45F, 1), (0x531, 0x556, 1), (0x561, 0x586, 1), (0x5D0, 0x5EA, 1),
    (0x621, 0x63A, 1), (0x641, 0x64A, 1), (0x660, 0x669, 1), (0x904, 0x939, 1), (0x966, 0x96F, 1), (0xE01, 0xE2E, 1), (0x10D0, 0x10F0, 1),
    (0x3041, 0x3096, 1), (0x30A1, 0x30FA, 1), (0x4E00, 0x9FA5, 1), (0xAC00, 0xD7A3, 1), (0xFF10, 0xFF19, 1),
]
HEX_ALPHABETS = [(0x61, 0x66, 1), (0x41, 0x46, 1)]
#: Ranges of a public address's first number that hold no private block; others stay.
FIRST_NUMBERS = [(1, 9), (11, 99), (101, 126), (128, 168), (170, 171), (173, 191), (193, 223), (224, 255)]
#: Ranges of the second number after a first one that has private blocks.
SECOND_NUMBERS = {172: [(0, 15), (16, 31), (32, 255)], 192: [(0, 167), (169, 255)], 169: [(0, 253)], 100: [(0, 63), (64, 127), (128, 255)]}


def hinted(text: Column) -> Column:
    out = text.rlike("[0-9@]")
    for hint in HINTS:
        out = out | text.contains(hint)
    return out


def kind_of(value: Column) -> Column:
    out = F.lit("person")
    for kind, pattern in reversed(KINDS[:-1]):
        out = F.when(value.rlike(f"^(?:{pattern})$"), kind).otherwise(out)
    return out


def canonical(kind: Column, value: Column) -> Column:
    """What entities are told apart by."""
    numbers = F.array_join(F.transform(F.split(value, r"\."), lambda p: p.cast("int").cast("string")), ".")
    return F.when(kind == "email", F.lower(value)).when(kind == "ip", numbers).otherwise(value)


def noise(key: str, *parts: Column) -> Column:
    """128 hex digits that only the key and the parts decide."""
    return F.sha2(F.concat_ws("\x1f", F.lit(key), *parts), 512)


def number(digits: Column, i: Column) -> Column:
    """The i-th number of 16 bits in hex digits; it repeats after 32."""
    return F.conv(F.substr(digits, (i % 32) * 4 + 1, F.lit(4)), 16, 10).cast("int")


def characters(value: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(value)), lambda i: F.substr(value, i, F.lit(1)))


def symbol(code: Column, low: Column | int, step: int, size: Column | int) -> Column:
    as_int = lambda x: (x if isinstance(x, Column) else F.lit(x)).cast("int")
    return F.struct(code.cast("int").alias("code"), as_int(low).alias("low"), as_int(step).alias("step"), as_int(size).alias("size"))


def of_alphabets(code: Column, alphabets: list[tuple[int, int, int]], otherwise: Column) -> Column:
    out = otherwise
    for low, high, step in reversed(alphabets):
        out = F.when(code.between(low, high) & ((code - low) % step == 0), symbol(code, low, step, (high - low) // step + 1)).otherwise(out)
    return out


def text_symbols(kind: Column, value: Column) -> Column:
    """The characters of a value with their alphabets; those that stay have an alphabet of one."""
    length = F.length(value)
    label = F.length(F.substring_index(F.substring_index(value, "@", -1), ".", 1))
    country = F.length(F.regexp_extract(value, r"^\+[0-9]{1,3}(?=[ .(-])", 0))
    after = F.when(kind == "secret", F.when(value.rlike("^(AKIA|gh)"), 4).when(value.startswith("sk-"), 3).otherwise(0)).when(kind == "iban", 4).when(kind == "card", 1).when(kind == "phone", country).otherwise(0)
    until = F.when(kind == "email", F.length(F.substring_index(value, "@", 1)) + 1 + label).when(kind == "card", length - 1).otherwise(length)
    hexadecimal = (kind == "secret") & ~value.rlike("[^0-9A-Fa-f]")

    def of(c: Column, i: Column) -> Column:
        code = F.ascii(c)
        stays = symbol(code, code, 1, 1)
        own = of_alphabets(code, ALPHABETS, stays)
        own = F.when(hexadecimal & c.rlike("[A-Fa-f]"), of_alphabets(code, HEX_ALPHABETS, stays)).otherwise(own)
        return F.when((i < after) | (i >= until), stays).otherwise(own)

    return F.transform(characters(value), of)


def ip_symbols(value: Column) -> Column:
    """The numbers of an address; private and other reserved ranges stay."""
    parts = F.split(value, r"\.")
    a, b = (F.get(parts, i).cast("int") for i in (0, 1))
    kept = a.isin(0, 10, 127, *SECOND_NUMBERS)

    def within(x: Column, ranges: list[tuple[int, int]], otherwise: Column) -> Column:
        return of_alphabets(x, [(low, high, 1) for low, high in ranges], otherwise)

    def of(p: Column, i: Column) -> Column:
        x = p.cast("int")
        stays = symbol(x, x, 1, 1)
        second = within(x, [(0, 255)], stays)
        for first, ranges in SECOND_NUMBERS.items():
            second = F.when(a == first, within(x, ranges, stays)).otherwise(second)
        second = F.when((a == 192) & (b == 168), stays).otherwise(second)
        return F.when(i == 0, F.when(kept, stays).otherwise(within(x, FIRST_NUMBERS, stays))).when(i == 1, second).otherwise(within(x, [(0, 255)], stays))

    return F.transform(parts, of)


def permuted(symbols: Column, key: str, *parts: Column) -> Column:
    """Codes of the symbols after a Feistel network: in each round the places of one parity move by what the others say."""
    places = F.sequence(F.lit(0), F.size(symbols) - 1)

    def round_(codes: Column, r: Column) -> Column:
        others = F.filter(codes, lambda c, i: i % 2 != r % 2)
        digits = noise(key, *parts, r.cast("string"), F.array_join(others.cast("array<string>"), ","))

        def moved(by: Column) -> Column:
            def one(i: Column) -> Column:
                s, c = F.get(symbols, i), F.get(codes, i)
                new = s["low"] + s["step"] * ((((c - s["low"]) / s["step"]).cast("int") + number(by, (i / 2).cast("int"))) % s["size"])
                return F.when((i % 2 == r % 2) & (s["size"] > 1), new).otherwise(c)

            return F.transform(places, one)

        return F.element_at(F.transform(F.array(digits), moved), 1)  # the digits are made once a round

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), F.transform(symbols, lambda s: s["code"]), round_)


def spelled(codes: Column) -> Column:
    return F.array_join(F.transform(codes, lambda c: F.decode(F.unhex(F.lpad(F.hex(c.cast("long")), 8, "0")), "UTF-32")), "")


def luhn_sum(value: Column) -> Column:
    """Sum of the Luhn rule over the digits, the last one being the check digit."""
    reversed_ = F.split(F.reverse(F.regexp_replace(value, "[^0-9]", "")), "")
    each = F.transform(reversed_, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x)


def card(value: Column, made: Column) -> Column:
    """made with a check digit that is as far from the right one as that of value."""
    body = F.substr(made, F.lit(1), F.length(made) - 1)
    return F.concat(body, ((luhn_sum(value) - luhn_sum(F.concat(body, F.lit("0")))) % 10 + 10).cast("int").cast("string").substr(-1, 1))


def mod_97(value: Column) -> Column:
    """An account number, country and check digits moved to the end, modulo 97."""
    plain = F.regexp_replace(value, " ", "")
    moved = F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))
    step = lambda a, c: F.when(F.ascii(c) <= 57, (a * 10 + F.ascii(c) - 48) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97)
    return F.aggregate(characters(moved), F.lit(0), step)


def iban(value: Column, made: Column) -> Column:
    """made with right check digits if value has them."""
    country, rest = F.substr(made, F.lit(1), F.lit(2)), F.substr(made, F.lit(5))
    right = F.lpad((98 - mod_97(F.concat(country, F.lit("00"), rest))).cast("string"), 2, "0")
    return F.when(mod_97(value) == 1, F.concat(country, right, rest)).otherwise(made)


def pick(options: list[str], at: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, options)), at % len(options) + 1)


def syllables(digits: Column, script: Column, n: Column, start: int = 0) -> Column:
    """A name of n syllables."""

    def of(name: str) -> Column:
        return F.array_join(F.transform(F.sequence(F.lit(1), n), lambda i: pick(SYLLABLES[name], number(digits, i + start))), "")

    out = of("Latn")
    for name in SCRIPTS:
        out = F.when(script == name, of(name)).otherwise(out)
    return F.initcap(out)


def name(kind: Column, value: Column, draw: Column, key: str) -> Column:
    """A candidate for a part of a name; kind is given:gender:script or surname:script."""
    digits, parts = noise(key, kind, value, draw.cast("string")), F.split(kind, ":")
    is_given, gender = kind.startswith("given"), F.get(parts, 1)
    script = F.element_at(parts, -1)
    listed = F.lit("")
    for (g, s), names in GIVEN.items():
        listed = F.when((gender == g) & (script == s), pick(names, number(digits, F.lit(0)))).otherwise(listed)
    length = F.greatest(F.round(F.length(value) / 3).cast("int"), F.lit(2))
    first = F.when(draw == 0, listed).otherwise(F.concat(listed, F.lit("-"), syllables(digits, script, draw + 1, 1)))
    return F.when(is_given, first).otherwise(syllables(digits, script, length + draw))


def is_name(kind: Column) -> Column:
    return kind.contains(":")


def candidate(kind: Column, value: Column, symbols: Column, draw: int, key: str) -> Column:
    codes = permuted(symbols, key, kind, F.lit(str(draw)))
    text = spelled(codes)
    return (
        F.when(is_name(kind), name(kind, value, F.lit(draw), key))
        .when(kind == "ip", F.array_join(codes.cast("array<string>"), "."))
        .when(kind == "card", card(value, text))
        .when(kind == "iban", iban(value, text))
        .otherwise(text)
    )


def form(kind: Column, value: Column, symbols: Column) -> Column:
    """What the values of a format have in common."""
    alphabets = F.array_join(F.transform(symbols, lambda s: F.concat_ws(":", s["low"].cast("string"), s["size"].cast("string"))), ",")
    inner = F.array_join(F.transform(F.slice(symbols, F.lit(1), F.size(symbols) - 1), lambda s: F.concat_ws(":", s["low"].cast("string"), s["size"].cast("string"))), ",")
    of_card = F.concat_ws("/", inner, (luhn_sum(value) % 10 == 0).cast("string"))
    return F.when(is_name(kind), kind).when(kind == "card", of_card).otherwise(alphabets)


def circle(left: DataFrame, all_: DataFrame, key: str) -> DataFrame:
    """(kind, value, surrogate) of entities whose formats have no free value: within a format each takes the next one's value."""
    shaped = left.withColumn("form", form(F.col("kind"), F.col("value"), F.col("symbols")))
    around = Window.partitionBy("kind", "form").orderBy(noise(key, F.col("kind"), F.col("value")), "value")
    whole = around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    turned = shaped.withColumn("next", F.coalesce(F.lead("value").over(around), F.first("value").over(whole))).drop("symbols")
    known = all_.withColumn("form", form(F.col("kind"), F.col("value"), F.col("symbols"))).groupBy("kind", "form").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    other = F.when(F.col("low") != F.col("value"), F.col("low")).when(F.col("high") != F.col("value"), F.col("high"))
    code = F.concat(F.lit("["), F.col("kind"), F.lit("-"), F.substr(noise(key, F.col("kind"), F.col("value")), F.lit(1), F.lit(16)), F.lit("]"))
    found = F.when(F.col("next") != F.col("value"), F.col("next")).otherwise(F.coalesce(other, code))
    return turned.join(known, ["kind", "form"]).select("kind", "value", found.alias("surrogate"))


def assign(entities: DataFrame, key: str) -> DataFrame:
    """(kind, value, surrogate) of distinct (kind, value): drawn, checked against all others, drawn again where needed."""
    kind, value = F.col("kind"), F.col("value")
    symbols = F.when(~is_name(kind), F.when(kind == "ip", ip_symbols(value)).otherwise(text_symbols(kind, value)))
    wanted = written(entities.distinct().withColumn("symbols", symbols), "entities")
    real = wanted.select("kind", F.col("value").alias("surrogate"))
    taken, pending, done = None, wanted, []
    for draw in range(DRAWS):
        cand = pending.select("kind", "value", candidate(kind, value, F.col("symbols"), draw, key).alias("surrogate"))
        # names are compared without case, as they are told apart
        cand = cand.withColumn("surrogate_", F.when(is_name(kind), F.lower("surrogate")).otherwise(F.col("surrogate")))
        best = cand.groupBy("kind", "surrogate_").agg(F.min(F.struct("value", "surrogate")).alias("s"))
        best = best.select("kind", F.col("surrogate_").alias("surrogate"), F.col("s.value").alias("value"), F.col("s.surrogate").alias("new")).join(real, ["kind", "surrogate"], "left_anti")
        if taken is not None:
            best = best.join(taken, ["kind", "surrogate"], "left_anti")
        won = written(best.select("kind", "value", "surrogate", "new"), f"draw{draw}")
        done.append(won.select("kind", "value", F.col("new").alias("surrogate")))
        taken = won.select("kind", "surrogate") if taken is None else taken.union(won.select("kind", "surrogate"))
        left = written(pending.join(won.select("kind", "value"), ["kind", "value"], "left_anti"), f"left{draw}")
        if pending is not wanted:
            discard(pending)
        pending = left
        if pending.isEmpty():
            break
    else:
        done.append(circle(pending, wanted, key))
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out


def script_of(value: Column) -> Column:
    out = F.lit("Latn")
    for short, long in SCRIPTS.items():
        out = F.when(value.rlike(rf"\p{{Is{long}}}"), short).otherwise(out)
    return out


def words_of(value: Column) -> Column:
    """The words of a person as (part, kind, word, value); kind is null for words that don't need a drawn name."""
    bare = lambda w: F.upper(F.regexp_replace(w, r"\.", ""))
    upper = {g: [t.upper() for t in ts] for g, ts in TITLES.items()}
    words = F.split(value, " ")
    first = F.get(F.filter(F.transform(words, lambda w: F.when(bare(w).isin(upper["m"]), "m").when(bare(w).isin(upper["f"]), "f")), lambda g: g.isNotNull()), 0)
    gender, n = F.coalesce(first, F.lit("n")), F.size(words)

    def of(w: Column, i: Column) -> Column:
        title = bare(w).isin([t for ts in upper.values() for t in ts])
        stays = title | w.isin(PARTICLES)
        kind = F.when(stays | w.rlike(rf"^{INITIALS}$"), None).when(i == n - 1, F.concat_ws(":", F.lit("surname"), script_of(w))).otherwise(F.concat_ws(":", F.lit("given"), gender, script_of(w)))
        return F.struct(i.alias("part"), kind.alias("kind"), w.alias("word"), F.lower(w).alias("value"), stays.alias("stays"))

    return F.transform(words, of)


def initials(word: Column, key: str) -> Column:
    """Other letters of the same alphabets, by a shift that is never zero."""
    by = number(noise(key, F.lit("initials")), F.lit(0))

    def of(c: Column) -> Column:
        s = of_alphabets(F.ascii(c), ALPHABETS, symbol(F.ascii(c), F.ascii(c), 1, 1))
        return F.when(s["size"] > 1, s["low"] + s["step"] * ((((s["code"] - s["low"]) / s["step"]).cast("int") + 1 + by % (s["size"] - 1)) % s["size"])).otherwise(s["code"])

    return spelled(F.transform(characters(word), of))


def people(uses: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(kind, value) of the names in persons, and a table (person, part, kind, value, word, stays) of their words."""
    spread = uses.filter("kind = 'person'").select(F.col("value").alias("person")).distinct().select("person", F.explode(words_of(F.col("person"))).alias("w"))
    words = written(spread.select("person", "w.*"), "words")
    return words.filter("kind IS NOT NULL").select("kind", "value"), words


def named(words: DataFrame, map_: DataFrame, key: str) -> DataFrame:
    """(kind, value, surrogate) of whole persons."""
    joined = words.join(map_, ["kind", "value"], "left")
    upper = (F.upper("word") == F.col("word")) & (F.length("word") > 1)
    new = F.when(F.col("stays"), F.col("word")).when(F.col("kind").isNull(), initials(F.col("word"), key)).when(upper, F.upper("surrogate")).otherwise(F.col("surrogate"))
    whole = joined.groupBy("person").agg(F.array_sort(F.collect_list(F.struct("part", new.alias("new")))).alias("parts"))
    return whole.select(F.lit("person").alias("kind"), F.col("person").alias("value"), F.array_join(F.transform("parts", lambda p: p["new"]), " ").alias("surrogate"))


def cased(raw: Column, surrogate: Column) -> Column:
    """The surrogate with capitals where raw has them."""
    pairs = F.zip_with(characters(raw), characters(surrogate), lambda r, s: F.when((F.lower(r) != r) & (F.length(F.upper(s)) == 1), F.upper(s)).otherwise(s))
    return F.when((F.lower(raw) == raw) | (F.length(raw) != F.length(surrogate)), surrogate).otherwise(F.array_join(pairs, ""))


def looked_up(uses: DataFrame, whole: DataFrame) -> DataFrame:
    """uses with their surrogate. Rows of an entity with over FREQUENT uses are dealt into SALTS ways, by a list of these
    entities whose length is bounded by the number of uses over FREQUENT, and so by 50,000."""
    total = uses.count()
    often = uses.groupBy("kind", "value").count().filter(F.col("count") > max(FREQUENT, total // 50_000)).select("kind", "value", F.lit(True).alias("often"))
    often = written(often, "frequent")
    marked = uses.join(F.broadcast(often), ["kind", "value"], "left").withColumn("salt", F.when(F.col("often"), F.pmod(F.xxhash64("pii_id", "pii_key"), F.lit(SALTS))).otherwise(F.lit(0)).cast("int")).drop("often")
    ways = F.when(F.col("often"), F.array(*map(F.lit, range(SALTS)))).otherwise(F.array(F.lit(0)))
    spread = whole.join(F.broadcast(often), ["kind", "value"], "left").withColumn("salt", F.explode(ways)).drop("often")
    return marked.join(spread, ["kind", "value", "salt"]).drop("salt")


def replace(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", key: str = "bookflow") -> DataFrame:
    """df with surrogates in its texts, and a last column pii_kinds array<string>: kinds of the entities of the row."""
    kept = [c for c in df.columns if c.lower() != "pii_kinds"]
    df = df.select(*(df[c] for c in kept))
    found, of_key, of_id, met_id, met_key, met_map = unused(df, "pii_found", "pii_key", "pii_id", "pii_of", "pii_hash", "pii_map")
    marked = df.withColumn(found, F.when(hinted(F.col(text_col)), F.regexp_extract_all(F.col(text_col), F.lit(ENTITY), F.lit(0))))
    some = F.size(F.coalesce(F.col(found), F.array().cast("array<string>"))) > 0
    rest = marked.filter(~some).select(*kept, F.array().cast("array<string>").alias("pii_kinds"))
    keyed = marked.filter(some).withColumn(of_key, F.xxhash64(text_col)).withColumn(of_id, F.col(id_col).cast("string"))
    uses = keyed.select(F.col(of_id).alias("pii_id"), F.col(of_key).alias("pii_key"), F.explode(F.array_distinct(F.col(found))).alias("raw"))
    uses = written(uses.withColumn("kind", kind_of(F.col("raw"))).withColumn("value", canonical(F.col("kind"), F.col("raw"))), "uses")

    parts, words = people(uses, key)
    map_ = written(assign(uses.filter("kind <> 'person'").select("kind", "value").union(parts), key), "surrogates")
    whole = written(map_.filter(~is_name(F.col("kind"))).union(named(words, map_, key)), "replacements")

    new = F.when(F.col("kind") == "email", cased(F.col("raw"), F.col("surrogate"))).otherwise(F.col("surrogate"))
    met = looked_up(uses, whole).groupBy("pii_id", "pii_key").agg(F.map_from_entries(F.collect_set(F.struct("raw", new.alias("new")))).alias(met_map), F.array_sort(F.collect_set("kind")).alias("pii_kinds"))
    met = met.select(F.col("pii_id").alias(met_id), F.col("pii_key").alias(met_key), met_map, "pii_kinds")
    joined = keyed.join(met, F.col(of_id).eqNullSafe(F.col(met_id)) & (F.col(of_key) == F.col(met_key)))
    between = F.split(F.col(text_col), ENTITY)
    text = F.concat(F.element_at(between, 1), F.array_join(F.zip_with(F.transform(found, lambda e: F.element_at(met_map, e)), F.slice(between, F.lit(2), F.size(found)), lambda e, t: F.concat(e, t)), ""))
    return joined.withColumn(text_col, text).select(*kept, "pii_kinds").union(rest)


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = replace(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "text", F.array_join("pii_kinds", ",").alias("kinds"))
