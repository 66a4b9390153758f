"""Personal data: detected entities give way to keyed surrogates of the same kind [DataFrame operations only].

Found are e-mail addresses, IPv4 and IPv6 addresses, account numbers (IBAN) and payment card numbers with right check
digits, telephone numbers (international, and national ones as the US, France, Germany and Spain write them), access
keys, passwords and tokens, and names after a form of address; what names a person once is replaced wherever it stands in
that text, surnames alone and given names before one. A surrogate depends on the key, the kind and the
normalised entity alone, so one entity gets one surrogate wherever it stands and however it is written (coreference).
It keeps the format: separators, length of digit runs, country code, letter case, the first digit of a card, check
digits. A name is replaced word for word: the last word is a surname, what stands before it a given name of the gender
of the form of address, and both keep their script, so "Mr John Smith" and "Mr Smith" share their surname afterwards.

Distinctness is checked over the whole corpus and over every entity of every mention: those whose surrogates meet, or
whose surrogate is itself an entity of the corpus, are drawn again, all but one, until none meet; it is an error when MAX_DRAWS rounds
in a row leave no fewer of them (a format whose values are all but used up).

Cases: a null text stays null and an empty one empty, both with no entity; repeated rows get equal texts; texts of any
length are handled in their row, which is never exploded; the patterns bound every repetition of a group, so no text
can exhaust the stack; an input column named n_entities gives way to the operator's, all others pass through under any
name; an empty table gives an empty table.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.sources.staging import release, staged

#: Names the session setting that holds the secret; KEY serves where it isn't set, as in tests.
KEY_SETTING, KEY = "spark.leafmill.pii.key", "leafmill-surrogates"
MAX_DRAWS = 16
BETWEEN = "\x1f"

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: Forms of address by gender, and given names by gender and script: fixed values.
MALE_TITLES, FEMALE_TITLES = ["Mr", "Herr", "Monsieur", "Señor", "Sr", "Господин", "Κύριος"], ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа", "Κυρία"]
#: Forms of address of either gender; a given name's last letter decides.
OTHER_TITLES = ["Dr", "Prof"]
NAMES = {
    ("m", "latin"): ["Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Gustav", "Hugo", "Ivan", "Jonas", "Karl", "Leo", "Max", "Noah", "Oscar", "Paul"],
    ("f", "latin"): ["Anna", "Berta", "Clara", "Dora", "Emma", "Flora", "Greta", "Hanna", "Ida", "Julia", "Klara", "Lena", "Maria", "Nora", "Olga", "Paula"],
    ("m", "cyrillic"): ["Алексей", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Кирилл", "Лев", "Максим", "Никита", "Олег", "Павел", "Роман", "Сергей", "Тимур"],
    ("f", "cyrillic"): ["Анна", "Белла", "Вера", "Галина", "Дарья", "Елена", "Жанна", "Зоя", "Ирина", "Кира", "Лидия", "Мария", "Нина", "Ольга", "Полина", "Раиса"],
    ("m", "greek"): ["Άρης", "Βασίλης", "Γιώργος", "Δημήτρης", "Ηλίας", "Θανάσης", "Κώστας", "Λάμπρος"],
    ("f", "greek"): ["Άννα", "Βάσω", "Γεωργία", "Δήμητρα", "Ελένη", "Ζωή", "Κατερίνα", "Λυδία"],
}
#: Letters that surnames are spelt with, and how given names that aren't of a list end.
LETTERS = {"latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзийклмнопрстуфхцчшщэюя", "greek": "αβγδεζηθικλμνξοπρστυφχψω", "armenian": "աբգդեզէըթժիլխծկհձղճմ"}
ENDINGS = {"latin": ("o", "a"), "cyrillic": ("ий", "ия"), "greek": ("ος", "α"), "armenian": ("ո", "ա")}
#: Countries with account numbers of this form, and calling codes of one and two digits (the rest have three): fixed values.
IBAN_COUNTRIES = "AD AE AL AT AZ BA BE BG BH BR BY CH CR CY CZ DE DK DO EE EG ES FI FO FR GB GE GI GL GR GT HR HU IE IL IQ IS IT JO KW KZ LB LC LI LT LU LV MC MD ME MK MR MT MU NL NO PK PL PS PT QA RO RS SA SC SE SI SK SM ST SV TL TN TR UA VA VG XK"
CALLING_CODES = r"^\+(?:([17])|(2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])|([0-9]{1,3}))"

_IBAN = rf"(?:{IBAN_COUNTRIES.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?"
#: Kind -> pattern, tried in this order at each place. A cheap look at the next or the last character comes first. No pattern can start inside a longer run of its own letters, and groups repeat a bounded number of times.
KINDS = {
    "email": r"(?=[A-Za-z0-9._%+-])(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}\.){1,126}[A-Za-z]{2,24}(?![A-Za-z0-9])",
    "ip": rf"(?=[0-9])(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])",
    "ipv6": r"(?=[0-9A-Fa-f]{1,4}:)(?<![0-9A-Za-z:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){2,6}(?::[0-9A-Fa-f]{1,4}){1,5})(?![0-9A-Za-z:])",
    "iban": rf"(?=[A-Z]{{2}}[0-9]{{2}})(?<![0-9A-Za-z]){_IBAN}(?![0-9A-Za-z])",
    "card": r"(?=[3-6])(?<![0-9A-Za-z])(?:[3-6][0-9]{3}(?:[ -]?[0-9]{4}){3}|3[47][0-9]{2}[ -]?[0-9]{6}[ -]?[0-9]{5})(?![0-9A-Za-z])",
    "phone": "(?=[0-9+(])(?:" + "|".join([
        r"(?<![0-9A-Za-z])(?:\+[0-9]{1,3}[ .-]?)(?:\([0-9]{2,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}(?![0-9A-Za-z]|\.[0-9])",
        r"(?<![0-9A-Za-z])\([0-9]{3}\) ?[0-9]{3}[.-][0-9]{4}(?![0-9])",
        r"(?<![0-9A-Za-z-])[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?![0-9-])",
        r"(?<![0-9A-Za-z+.-])0[1-9](?:[ .-][0-9]{2}){4}(?![0-9A-Za-z]|[.-][0-9])",
        r"(?<![0-9A-Za-z+.-])0[1-9][0-9]{1,4}[ /-][0-9]{5,8}(?![0-9A-Za-z]|[.-][0-9])",
        r"(?<![0-9A-Za-z+.-])[6-9][0-9]{2}(?: [0-9]{2}){3}(?![0-9A-Za-z]|[.-][0-9]| [0-9])",
        r"(?<![0-9A-Za-z+.-])0[1-9][0-9]{1,3}[ -][0-9]{3,4}[ -][0-9]{3,4}(?![0-9A-Za-z]|[.-][0-9]| [0-9])",
        r"(?<![0-9A-Za-z-])[0-8][0-9]{2}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    ]) + ")",
    "key": "|".join([
        r"(?=AKIA)(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9])",
        r"(?<=[=:])(?<=(?i:password)[=:])[^\x20\x09-\x0D\"']{6,64}",
        r"(?<=[=:] )(?<=(?i:password)[=:] )(?=[^\x20\x09-\x0D\"']{0,63}[0-9])[^\x20\x09-\x0D\"']{6,64}",
        r"(?<=\")(?<=(?i:token) = \")[A-Za-z0-9_-]{16,128}",
        r"(?=[0-9A-Fa-f]{32})(?<![A-Za-z0-9])(?=[A-Fa-f]*[0-9])[0-9A-Fa-f]{32,64}+(?![A-Za-z0-9])",
    ]),
    "name": r"(?=\p{Lu})(?<= )(?<=(?<![\p{L}])(?:" + "|".join(t for title in MALE_TITLES + FEMALE_TITLES + OTHER_TITLES for t in dict.fromkeys([title, title.upper()])) + r")\.? )\p{Lu}['’\p{L}]{1,30}+(?:-\p{Lu}\p{L}{1,30}+){0,2}(?: \p{Lu}['’\p{L}]{1,30}+(?:-\p{Lu}\p{L}{1,30}+){0,2}){0,2}",
}
ANY = "|".join(f"(?:{p})" for p in KINDS.values())
#: What stands before a value that is a secret whatever it looks like.
SECRET_NEXT = r"(?i)(?:password[=:] ?|token = \")$"
#: No text without one of these or of SPELT, in any case, holds an entity; a cheap first look. Hexadecimal keys are all but sure to hold a digit, and must.
SPELT = "[Aa][Ss][Ss][Ww][Oo][Rr][Dd][=:]|[Tt][Oo][Kk][Ee][Nn] = "
HINTS = ["@", *[t for title in MALE_TITLES + FEMALE_TITLES + OTHER_TITLES for t in dict.fromkeys([title, title.upper()])]]


def _let(value: Column, body) -> Column:
    """body(value) with value worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _chars(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


# ---- check digits


def luhn_total(digits: Column) -> Column:
    """Luhn's sum of a string of digits, from its last digit on."""
    last = F.length(digits) - 1

    def worth(c: Column, i: Column) -> Column:
        d = c.cast("int")
        return F.when((last - i) % 2 == 1, d * 2 - F.when(d > 4, 9).otherwise(0)).otherwise(d)

    return F.aggregate(F.transform(_chars(digits), worth), F.lit(0), lambda s, x: s + x)


def iban_rest(compact: Column) -> Column:
    """What is left modulo 97 of an account number without spaces; 1 if its check digits are right."""
    turned = F.concat(F.substring(compact, 5, 40), F.substring(compact, 1, 4))

    def step(s: Column, c: Column) -> Column:
        return F.when(c.rlike("^[0-9]$"), (s * 10 + c.cast("int")) % 97).otherwise((s * 100 + F.ascii(c) - 55) % 97)

    return F.aggregate(_chars(turned), F.lit(0), step)


# ---- kinds and norms


def kind_of(entity: Column, before: Column) -> Column:
    """Kind of an entity that stands alone, without what the patterns look behind for; null where its check digits are wrong."""
    out = F.when(before.rlike(SECRET_NEXT), "key")
    out = out.when(entity.rlike(r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+$"), "email")
    out = out.when(entity.rlike(rf"^(?:{_OCTET}\.){{3}}{_OCTET}$"), "ip")
    out = out.when(entity.rlike("^[0-9A-Fa-f]{1,4}:[0-9A-Fa-f:]+$"), "ipv6")
    is_iban = iban_rest(F.replace(entity, F.lit(" "), F.lit(""))) == 1
    out = out.when(entity.rlike(f"^{_IBAN}$"), F.when(is_iban, "iban").when(entity.rlike("^[0-9A-F]{32,64}$"), "key"))
    out = out.when(entity.rlike(r"^(?:[3-6][0-9]{3}(?:[ -]?[0-9]{4}){3}|3[47][0-9]{2}[ -]?[0-9]{6}[ -]?[0-9]{5})$"), F.when(luhn_total(_digits_of(entity)) % 10 == 0, "card"))
    out = out.when(entity.rlike(r"^[+(]?[0-9][0-9 ()./-]*$") & entity.rlike("[+( ./-]"), "phone")
    return out.when(entity.rlike(r"^\p{Lu}['’\p{L}]"), F.when(before.rlike(r"\p{L}\.? $"), "name").otherwise("key")).otherwise("key")


def norm_of(kind: Column, entity: Column) -> Column:
    """What must agree for two mentions to be one entity: case aside for addresses and names, punctuation aside for numbers."""
    folded = F.when(kind.isin("email", "ipv6", "surname", "given_m", "given_f"), F.lower(entity))
    folded = folded.when(kind == "phone", F.concat(F.when(entity.startswith("+"), "+").otherwise(""), _digits_of(entity)))
    return folded.when(kind == "card", _digits_of(entity)).when(kind == "iban", F.replace(entity, F.lit(" "), F.lit(""))).otherwise(entity)


def script_of(word: Column) -> Column:
    return F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic").when(word.rlike(r"\p{IsGreek}"), "greek").when(word.rlike(r"\p{IsArmenian}"), "armenian").otherwise("latin")


# ---- surrogates


def _hash(key: str, kind: Column, norm: Column, draw: Column) -> Column:
    return F.sha2(F.concat_ws(BETWEEN, F.lit(key), F.lit(""), kind, norm, draw.cast("string")), 256)


def _number(hexes: Column, i: Column) -> Column:
    """The i-th of 32 numbers below 256 that 64 hex digits hold."""
    return F.conv(F.substr(hexes, (2 * i + 1).cast("int"), F.lit(2)), 16, 10).cast("int")


def _letters(hexes: Column) -> Column:
    """Thirty-two letters a-z."""
    return F.transform(F.sequence(F.lit(0), F.lit(31)), lambda i: F.chr((F.lit(97) + _number(hexes, i) % 26).cast("long")))


def _digits(hexes: Column) -> Column:
    """Thirty-two digits."""
    return F.transform(F.sequence(F.lit(0), F.lit(31)), lambda i: (_number(hexes, i) % 10).cast("string"))


def _spelt(hexes: Column, script: Column, count: int) -> Column:
    """So many letters of a script."""

    def with_letters(which: str) -> Column:
        letter = lambda i: F.substr(F.lit(which), _number(hexes, i) % len(which) + 1, F.lit(1))
        return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(count - 1)), letter), "")

    return reduce(lambda c, s: c.when(script == s, with_letters(LETTERS[s])), LETTERS, F.when(F.lit(False), ""))


def _refill(entity: Column, digits: Column, lower: Column, keep: Column | int = 0) -> Column:
    """From the keep-th on, each digit gives way to the next of digits and each letter to one of lower in its own case; the rest stays."""

    def one(c: Column, i: Column) -> Column:
        j = (i % 32 + 1).cast("int")
        fresh = F.element_at(lower, j)
        return F.when(i < keep, c).when(c.rlike("^[0-9]$"), F.element_at(digits, j)).when(c.rlike("^[a-z]$"), fresh).when(c.rlike("^[A-Z]$"), F.upper(fresh)).otherwise(c)

    return F.array_join(F.transform(_chars(entity), one), "")


def _laid(entity: Column, compact: Column, what: str) -> Column:
    """The characters of compact in the places of those of entity that match what; the rest stays."""

    def step(s: Column, c: Column) -> Column:
        taken = F.concat(s["t"], F.substr(compact, s["n"] + 1, F.lit(1)))
        return F.when(c.rlike(what), F.struct(taken.alias("t"), (s["n"] + 1).alias("n"))).otherwise(F.struct(F.concat(s["t"], c).alias("t"), s["n"].alias("n")))

    return F.aggregate(_chars(entity), F.struct(F.lit("").alias("t"), F.lit(0).alias("n")), step, lambda s: s["t"])


def _fresh_digits(norm_digits: Column, hexes: Column, keep: Column | int) -> Column:
    """As many digits, of which the first keep stay."""
    return _let(_digits(hexes), lambda d: F.array_join(F.transform(_chars(norm_digits), lambda c, i: F.when(i < keep, c).otherwise(F.element_at(d, (i % 32 + 1).cast("int")))), ""))


class Drawn(NamedTuple):
    """An entity, its norm, the hash that its surrogate is made of, which draw that is, and the key."""

    entity: Column
    norm: Column
    hexes: Column
    draw: Column
    key: str


def _email(x: Drawn) -> Column:
    local, host = F.substring_index(x.entity, "@", 1), F.substring_index(x.entity, "@", -1)
    fresh = _letters(x.hexes)
    # letters of the first run give way to eight (room enough that few meet); digits and separators keep their form
    label = F.array_join(F.slice(fresh, 1, 8), "")
    head = F.when(local.rlike("^[A-Z]"), F.initcap(label)).otherwise(label)
    tail = _refill(F.regexp_replace(local, "^[A-Za-z]*", ""), _digits(x.hexes), F.slice(fresh, 9, 24))
    top = F.substring_index(host, ".", -1)
    body = F.substr(host, F.lit(1), F.length(host) - F.length(top))
    of_host = _hash(x.key, F.lit("host"), F.lower(host), F.lit(0))
    return F.concat(head, tail, F.lit("@"), _let(of_host, lambda h: _refill(body, _digits(h), _letters(h))), top)


def _ip(x: Drawn) -> Column:
    octet = lambda k: (F.conv(F.substring(x.hexes, 1 + 4 * k, 4), 16, 10).cast("int") % 254 + 1).cast("string")
    return F.concat_ws(".", *[octet(k) for k in range(4)])


def _ipv6(x: Drawn) -> Column:
    filled = F.array_join(F.transform(_chars(x.entity), lambda c, i: F.when(c == ":", c).otherwise(F.substr(x.hexes, (i % 64 + 1).cast("int"), F.lit(1)))), "")
    return F.when(x.entity.rlike("[A-F]"), F.upper(filled)).otherwise(filled)


def _iban(x: Drawn) -> Column:
    body = _refill(F.substring(x.norm, 5, 40), _digits(x.hexes), _letters(x.hexes))
    country = F.substring(x.norm, 1, 2)
    check = lambda b: F.lpad((98 - iban_rest(F.concat(country, F.lit("00"), b))).cast("string"), 2, "0")
    return _laid(x.entity, _let(body, lambda b: F.concat(country, check(b), b)), "[^ ]")


def _card(x: Drawn) -> Column:
    body = _let(_fresh_digits(x.norm, x.hexes, F.when(F.length(x.norm) == 15, 2).otherwise(1)), lambda d: F.substr(d, F.lit(1), F.length(d) - 1))
    check = lambda b: ((10 - luhn_total(F.concat(b, F.lit("0"))) % 10) % 10).cast("string")
    return _laid(x.entity, _let(body, lambda b: F.concat(b, check(b))), "[0-9]")


def _phone(x: Drawn) -> Column:
    code = F.length(F.regexp_extract(x.norm, CALLING_CODES, 0)) - 1
    keep = F.when(x.norm.startswith("+"), code).when(x.norm.startswith("0"), 1).otherwise(0)
    return _laid(x.entity, _fresh_digits(_digits_of(x.norm), x.hexes, keep), "[0-9]")


def _token(x: Drawn) -> Column:
    at = lambda i: F.substr(x.hexes, (i % 64 + 1).cast("int"), F.lit(1))
    lower = F.array_join(F.transform(_chars(x.entity), lambda c, i: at(i)), "")
    # hexadecimal in both cases: letters stand in the case of what they take the place of
    both = F.array_join(F.transform(_chars(x.entity), lambda c, i: F.when(c.rlike("^[A-Z]$"), F.upper(at(i))).otherwise(at(i))), "")
    other = _let(_letters(x.hexes), lambda l: _refill(x.entity, _digits(x.hexes), l, F.when(x.entity.startswith("AKIA"), 4).otherwise(0)))
    # one without letters or digits, or of too few of them to be told from others, becomes hexadecimal
    plain = x.entity.rlike("^[0-9a-f]+$") | ~x.entity.rlike("[0-9A-Za-z]") | (x.draw >= 4)
    return F.when(x.entity.rlike("^[0-9A-F]{32,64}$"), F.upper(lower)).when(x.entity.rlike("^[0-9A-Fa-f]{32,64}$"), both).when(plain, lower).otherwise(other)


def _cased(word: Column, like: Column) -> Column:
    return F.when((F.upper(like) == like) & (F.length(like) > 1), F.upper(word)).otherwise(F.initcap(word))


def _surname(x: Drawn) -> Column:
    script = script_of(x.norm)
    one = lambda w, i: _cased(_let(F.sha2(F.concat(x.hexes, i.cast("string")), 256), lambda h: _spelt(h, script, 7)), w)
    return F.array_join(F.transform(F.split(x.entity, "-"), one), "-")


def _given(gender: str):
    def made(x: Drawn) -> Column:
        script, first = script_of(x.norm), F.conv(F.substring(x.hexes, 1, 4), 16, 10).cast("int")
        listed = F.when(F.lit(False), "")
        for (g, s), names in NAMES.items():
            if g == gender:
                listed = listed.when(script == s, F.element_at(F.array(*map(F.lit, names)), first % len(names) + 1))
        ending = reduce(lambda c, s: c.when(script == s, ENDINGS[s][gender == "f"]), ENDINGS, F.when(F.lit(False), ""))
        # beyond the first draw, or without a list, a name is spelt
        spelt = F.concat(_spelt(x.hexes, script, 6), ending)
        return _cased(F.when(x.draw == 0, F.coalesce(listed, spelt)).otherwise(spelt), x.entity)

    return made


MAKERS = {"email": _email, "ip": _ip, "ipv6": _ipv6, "iban": _iban, "card": _card, "phone": _phone, "surname": _surname, "given_m": _given("m"), "given_f": _given("f"), "key": _token}


def surrogate(kind: Column, entity: Column, draw: Column, key: str = KEY) -> Column:
    """The draw-th surrogate of an entity: a function of key, kind and normalised entity, laid out as the entity is."""

    def made(norm: Column) -> Column:
        with_hash = lambda h: reduce(lambda c, k: c.when(kind == k, MAKERS[k](Drawn(entity, norm, h, draw, key))), MAKERS, F.when(F.lit(False), ""))
        return _let(_hash(key, kind, norm, draw), with_hash)

    return _let(norm_of(kind, entity), made)


# ---- texts


def _cut(text: Column) -> Column:
    """Struct of gaps and entities: gaps[0] entity[0] gaps[1] ... put together are the text."""
    some = reduce(lambda c, x: c | text.contains(x), HINTS, text.rlike("[0-9]")) | text.rlike(SPELT)
    found = F.when(some, F.regexp_extract_all(text, F.lit(ANY), F.lit(0)))
    return _let(found, lambda e: F.when(F.size(e) > 0, F.struct(F.split(text, ANY).alias("gaps"), e.alias("found"))))


def _parts(entity: Column, kind: Column, before: Column) -> Column:
    """What is replaced of a mention: array of (kind, entity), joined by blanks. A name has a part a word; null for no entity."""
    title = F.lower(F.regexp_extract(before, r"(\p{L}+)\.? $", 1))
    either = title.isin(*[t.lower() for t in OTHER_TITLES]) & entity.rlike(r"^['’\p{L}-]*(?iu:[aая]|α) ")
    woman = title.isin(*[t.lower() for t in FEMALE_TITLES]) | either

    def word(words: Column) -> Column:
        of = lambda i: F.when(i == F.size(words) - 1, "surname").when(woman, "given_f").otherwise("given_m")
        return F.transform(words, lambda w, i: F.struct(of(i).alias("kind"), w.alias("entity")))

    return F.when(kind == "name", _let(F.split(entity, " "), word)).when(kind.isNotNull(), F.array(F.struct(kind.alias("kind"), entity.alias("entity"))))


def _mentions(cut: Column) -> Column:
    """The parts of each entity, in order."""

    def one(e: Column, i: Column) -> Column:
        # what kind_of and _parts look at right before the entity may end an entity itself
        text = F.concat(F.coalesce(F.get(cut["found"], i - 1), F.lit("")), F.get(cut["gaps"], i))
        return _let(F.right(text, F.lit(40)), lambda before: _let(kind_of(e, before), lambda kind: _parts(e, kind, before)))

    return F.transform(cut["found"], one)


def _names(mentions: Column) -> Column:
    """The words of the persons found in a text, surnames first."""
    words = F.filter(F.flatten(F.filter(mentions, lambda p: p.isNotNull())), lambda e: e["kind"].isin("surname", "given_m", "given_f"))
    return F.array_distinct(F.concat(F.filter(words, lambda e: e["kind"] == "surname"), F.filter(words, lambda e: e["kind"] != "surname")))


def _bare(names: Column) -> Column:
    """Pattern of those words where no form of address stands: a surname, and a given name right before one, as found or in capitals."""
    either = lambda ws: F.array_join(F.array_distinct(F.concat(ws, F.transform(ws, F.upper))), "|")
    of = lambda surname: either(F.transform(F.filter(names, lambda e: (e["kind"] == "surname") == surname), lambda e: e["entity"]))
    surnames = F.concat(F.lit("(?:"), of(True), F.lit(r")(?![\p{L}-]|['’](?!s(?!\p{L}))\p{L})"))
    given = F.when(F.exists(names, lambda e: e["kind"] != "surname"), F.concat(F.lit("(?:"), of(False), F.lit(")(?= "), surnames, F.lit(")|"))).otherwise("")
    return F.concat(F.lit(r"(?<![\p{L}'’-])(?:"), given, surnames, F.lit(")"))


def entities(documents: DataFrame, *carry: str) -> DataFrame:
    """One row per part of a mention: the columns named, place, kind, entity, norm."""
    cut = documents.select(*carry, _cut(F.col("text")).alias("_cut")).where(F.size("_cut.found") > 0)
    parts = F.flatten(F.filter(_mentions(F.col("_cut")), lambda p: p.isNotNull()))
    rows = cut.select(*carry, F.posexplode(parts).alias("place", "_e"))
    return rows.select(*carry, "place", "_e.kind", "_e.entity", norm_of(F.col("_e.kind"), F.col("_e.entity")).alias("norm"))


def redraws(mentions: DataFrame, key: str = KEY) -> DataFrame:
    """kind, norm, draw of the entities that need another than their first surrogate.

    The norm of a surrogate depends on the norm of its entity alone, so one spelling stands for all of them. Partial
    aggregation leaves one row per entity and task, so a mention in a third of all documents costs nothing.
    """
    once = staged(mentions.groupBy("kind", "norm").agg(F.min("entity").alias("entity")), "entities")
    real = once.select("kind", F.col("norm").alias("s")).withColumn("taken", F.lit(True))
    drawn = norm_of(F.col("kind"), surrogate(F.col("kind"), F.col("entity"), F.col("draw"), key))
    rounds: list[DataFrame] = []  # of every round what it has drawn, and whether that stays
    left = once.withColumn("draw", F.lit(0))
    fewest, stalled = None, 0
    while True:
        given = staged(left.withColumn("s", drawn), "drawn")
        owner = given.groupBy("kind", "s").agg(F.min("norm").alias("owner"))
        told = given.join(owner, ["kind", "s"]).join(real, ["kind", "s"], "left")
        if rounds:
            settled = reduce(DataFrame.unionByName, rounds).where("stays").select("kind", "s").withColumn("given", F.lit(True))
            told = told.join(settled, ["kind", "s"], "left")
        else:
            told = told.withColumn("given", F.lit(None).cast("boolean"))
        stays = F.col("taken").isNull() & F.col("given").isNull() & (F.col("norm") == F.col("owner"))
        rounds.append(staged(told.select("kind", "norm", "entity", "draw", "s", stays.alias("stays")), "met"))
        release(given)
        n = rounds[-1].where("not stays").count()
        if not n:
            break
        stalled = 0 if fewest is None or n < fewest else stalled + 1
        if stalled >= MAX_DRAWS:
            raise ValueError(f"{n} entities have no surrogate of their own: their formats have too few free values")
        fewest = n if fewest is None else min(n, fewest)
        left = rounds[-1].where("not stays").select("kind", "norm", "entity", (F.col("draw") + 1).alias("draw"))
    out = staged(reduce(DataFrame.unionByName, rounds).where("stays and draw > 0").select("kind", "norm", "draw"), "redraws")
    release(once, *rounds)
    return out


def _unused(name: str, documents: DataFrame) -> str:
    taken = {c.lower() for c in documents.columns}
    while name in taken:
        name += "_"
    return name


def secret(spark: SparkSession) -> str:
    return spark.conf.get(KEY_SETTING, KEY)


def replace_entities(documents: DataFrame, key: str | None = None) -> DataFrame:
    """documents with text replaced, and n_entities (bigint), how many were. Other columns pass through.

    Redrawn entities are joined to the rows that hold them by a hash of the text: rows of different texts that agree in
    it see each other's redraws, which are the same everywhere.
    """
    key = secret(documents.sparkSession) if key is None else key
    row, known, done = (_unused(n, documents) for n in ("_row", "_known", "_done"))
    mentions = staged(entities(documents.select("text", F.xxhash64("text").alias("_row")), "_row").drop("place").distinct(), "mentions")
    again = redraws(mentions, key)
    held = mentions.select("_row", "kind", "norm").distinct().join(again, ["kind", "norm"])
    entry = F.struct(F.concat_ws(BETWEEN, "kind", "norm").alias("k"), F.col("draw").alias("d"))
    by_row = staged(held.groupBy("_row").agg(F.map_from_entries(F.collect_set(entry)).alias(known)).withColumnRenamed("_row", row), "redrawn")
    release(mentions, again)
    out = documents.drop("n_entities").withColumn(row, F.xxhash64("text")).join(by_row, row, "left")

    def fresh(e: Column) -> Column:
        name = F.concat_ws(BETWEEN, e["kind"], norm_of(e["kind"], e["entity"]))
        return _let(F.coalesce(F.element_at(F.col(known), name), F.lit(0)), lambda draw: surrogate(e["kind"], e["entity"], draw, key))

    def whole(cut: Column, mentions: Column) -> Column:
        """Text and number of entities. What stands between entities is looked through for the names that were found."""

        def told(names: Column) -> Column:
            bare = _let(_bare(names), lambda like: F.transform(cut["gaps"], lambda g: F.struct(F.split(g, like).alias("gaps"), F.regexp_extract_all(g, like, F.lit(0)).alias("found"))))
            gaps = F.when(F.size(names) > 0, bare).otherwise(F.transform(cut["gaps"], lambda g: F.struct(F.array(g).alias("gaps"), F.array().cast("array<string>").alias("found"))))
            # one list of all that is replaced, so that surrogates are worked out in one place
            of_name = lambda w: F.struct(F.element_at(F.filter(names, lambda n: F.lower(n["entity"]) == F.lower(w)), 1)["kind"].alias("kind"), w.alias("entity"))
            between = F.transform(gaps, lambda g: F.zip_with(g["gaps"], F.transform(g["found"], of_name), lambda t, e: F.struct(t.alias("gap"), F.array(e).alias("parts"))))
            own = F.transform(F.zip_with(mentions, cut["found"], lambda parts, e: F.struct(parts.alias("parts"), e.alias("as_is"))), lambda m: F.array(F.struct(F.when(m["parts"].isNull(), m["as_is"]).otherwise("").alias("gap"), m["parts"].alias("parts"))))
            pieces = F.flatten(F.zip_with(between, own, lambda b, o: F.concat(b, F.coalesce(o, F.array().cast("array<struct<gap:string,parts:array<struct<kind:string,entity:string>>>>")))))
            filled = lambda p: F.concat(p["gap"], F.coalesce(F.array_join(F.transform(F.filter(p["parts"], lambda e: e.isNotNull() & e["entity"].isNotNull()), fresh), " "), F.lit("")))
            n = F.size(F.filter(mentions, lambda p: p.isNotNull())) + F.aggregate(gaps, F.lit(0), lambda n, g: n + F.size(g["found"]))
            return F.struct(F.array_join(F.transform(pieces, filled), "").alias("text"), n.cast("long").alias("n"))

        return _let(_names(mentions), told)

    told = _let(_cut(F.col("text")), lambda cut: F.when(F.size(cut["found"]) > 0, _let(_mentions(cut), lambda m: whole(cut, m))))
    out = out.withColumn(done, told)
    out = out.withColumns({"text": F.coalesce(f"{done}.text", "text"), "n_entities": F.coalesce(f"{done}.n", F.lit(0).cast("long"))})
    return out.select(*[c for c in documents.columns if c != "n_entities"], "n_entities")
