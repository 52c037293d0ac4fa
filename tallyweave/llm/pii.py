"""Personal data replaced by keyed surrogates of the same kind. DataFrame functions only.

Kinds: e-mail addresses, IPv4 addresses, phone, payment card and social security numbers, IBANs, hexadecimal secrets, keys
of known services, and personal names: a known first name and a surname, a title and a surname, and the surname alone in
a text that names it in one of these ways. A surrogate depends on a secret key, the kind and the normal form of what it
replaces, so one person's address is replaced by the same text wherever it stands and in whatever layout: that is the
coreference kept. Layout is kept too: digits are put where digits stood, capitals stay.

* Digits go through a keyed permutation (a Feistel network over their two halves), so distinct numbers stay distinct.
  Country codes, fictional exchanges (555) and a card's check digit being right or wrong are kept.
* Secrets, keys and addresses are spelled from keyed hashes.
* First names go through a keyed cycle of the names of their script and gender. Surnames are put together from syllables
  of their script, each part of a double one by itself; feminine forms of Cyrillic ones stay feminine, and both forms of a
  name go together. So "Mary Smith", "Ms Smith" and "Smith" share a surname afterwards, as John and Mary Smith do.

Collision checks: all distinct entities of the table are gathered; where two would get one surrogate, or one would get
something that is itself somebody's original, all but the first are given the next of an endless series of surrogates
(surnames grow by a syllable each time), until none is left. Only texts with such an entity are joined to these
exceptions; all others are replaced in one pass without a shuffle.

Null and empty texts stay as they are, with no entities; an empty table gives an empty one. Overlapping finds do not
occur: the pattern is matched from left to right. Long texts are replaced whole. Repeated rows are replaced alike. Of two
entities with one surrogate the smaller original keeps it. Other columns are kept, whatever their names; one named like
the count gives way to it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.session import cut

#: Attempts after which a domain counts as used up.
ATTEMPTS = 64
ROUNDS = 8
#: Exceptional entities in texts, one text's counted each, up to which these are sent to all tasks (some 20 MB); more are
#: joined by a shuffle, with the same result.
SENT_ENTITIES = 100_000

# First names by script and gender.
FIRST_NAMES = {
    ("latin", "f"): "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Emily Laura Anna Julia Sophie Marie Camille Claire Ursula Petra Sabine Heike Carmen Lucia Elena Isabel".split(),
    ("latin", "m"): "James Robert John Michael William David Richard Joseph Thomas Charles Daniel Matthew Paul Peter Pierre Jean Michel Louis Hans Klaus Jürgen Stefan Carlos José Juan Miguel".split(),
    ("cyrillic", "f"): "Анна Мария Елена Ольга Наталья Татьяна Ирина Светлана".split(),
    ("cyrillic", "m"): "Иван Александр Сергей Дмитрий Андрей Алексей Михаил Николай".split(),
}
# Syllables that surnames are put together from.
SYLLABLES = {
    "latin": ("Al Bar Cal Dor El Far Gar Hal Ker Lam Mar Nor Or Pel Ros Tal".split(), "an be ca do en fi go in la mo ne or pa ri so ta".split(), "berg dale field ford land ley man mont ner rick ser son stein ton ver well".split()),
    "cyrillic": ("Ба Ве Го До Же За Ка Ла Ма Не По Ро Са Та Фе Ша".split(), "ба ва го до ла ли ма на ни по ра ри са та хо ша".split(), "ев ин ков лов нов ров сов тов".split()),
}
#: Phone numbers: +1 and ten digits, E.164 after + or 00 in any grouping, grouped by three, three and four, and those of
#: France, of Germany and Britain (trunk 0), and of Spain.
PHONES = (
    r"\+1(?:[ .()/-]{0,2}[0-9]){10}",
    r"(?:\+(?!1)|(?<![0-9.,+-])00)[1-9](?:[ .()/-]{0,2}[0-9]){7,14}",
    r"(?:\+[0-9]{1,3}[ .-]?\(?[0-9]{3}\)?|(?<![0-9(])\([0-9]{3}\)|(?<![0-9.+-])[0-9]{3}(?=[.-]))[ .-]?[0-9]{3}[ .-][0-9]{4}",
    r"(?<![0-9.,+-])[2-9][0-9]{2} [2-9][0-9]{2}[ .-][0-9]{4}",
    r"(?<![0-9.,+-])0[1-9](?:[ .-]?[0-9]{2}){4}",
    r"(?<![0-9.,+-])(?=(?:[ ()/-]{0,2}[0-9]){8})\(?0[1-9][0-9]{1,4}\)?[ /-]{1,2}[0-9]{2,8}(?:[ -][0-9]{2,5}){0,3}",
    r"(?<![0-9.,+-])(?:[679][0-9]{2} [0-9]{3} [0-9]{3}|[6-9][0-9]{2}(?:[ .-][0-9]{2}){3})",
)
PREFIXES = {
    "email": r"[\p{L}\p{N}][\p{L}\p{N}._%+-]*@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)+",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "secret": r"(?<![0-9A-Za-z])(?=[0-9]*[A-Fa-f])(?=[A-Fa-f]*[0-9])[0-9A-Fa-f]{32,64}(?![0-9A-Za-z])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "card": r"(?<![0-9])[0-9]{4}(?:[ -]?[0-9]{4}){3}(?![0-9])|(?<![0-9])3[47][0-9]{2}[ -]?[0-9]{6}[ -]?[0-9]{5}(?![0-9])",
    "phone": rf"(?:{'|'.join(PHONES)})(?![0-9])",
    "ip": r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?!\.?[0-9])",
}
# Forms of address before a surname, by gender where they tell it.
TITLES = {
    "f": "Mrs Ms Miss Madam Madame Mme Mlle Frau Señora Señorita Sra Srta г-жа госпожа Г-жа Госпожа".split(),
    "m": "Mr Sir Monsieur Herr Herrn Señor Sr г-н господин Г-н Господин".split(),
    "": "Dr Prof Professor Docteur Doctor Доктор доктор".split(),
}
# What keys of known services look like, beginning in the first group.
TOKENS = (
    r"((?:AKIA|ASIA))[0-9A-Z]{16}",
    r"(gh[oprsu]_)[0-9A-Za-z]{36,}",
    r"(sk-)[0-9A-Za-z_-]{20,}",
    r"(xox[abprs]-)[0-9A-Za-z-]{10,}",
    r"(AIza)[0-9A-Za-z_-]{35}",
    r"(eyJ)[0-9A-Za-z_-]{10,}\.[0-9A-Za-z_-]{10,}\.[0-9A-Za-z_-]{10,}",
)
TOKEN = rf"(?<![0-9A-Za-z_-])(?:{'|'.join(t.replace('(', '(?:', 1) for t in TOKENS)})(?![0-9A-Za-z_-])"
_NAMES = [n for names in FIRST_NAMES.values() for n in names]
_TITLES = [t for titles in TITLES.values() for t in titles]
#: The look at the first letter comes first: it is what most places fail on.
_SURNAME = r"(?:\p{Lu}['’])?\p{Lu}\p{Ll}+(?:['’]?\p{Lu}\p{Ll}+)*"
_FIRST = "|".join(_NAMES)
NAME = rf"(?=[{''.join(sorted({n[0] for n in [*_NAMES, *_TITLES]}))}])(?<![\p{{L}}\p{{N}}])(?:(?:{_FIRST})|(?:{'|'.join(_TITLES)})\.?(?! (?:{_FIRST}) \p{{Lu}})) {_SURNAME}(?:-{_SURNAME})?(?![\p{{L}}\p{{N}}])"
#: Cyrillic surnames with two forms: what the feminine ends with, and the masculine of the same stem.
FEMININE, MASCULINE = "(?:ов|ев|ёв|ин|ын)а$", "(?:ов|ев|ёв|ин|ын|ский|цкий)$"
#: Country code after + or 00, or a trunk 0.
COUNTRY = r"^(?:(?:\+|00)(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})|0)"
#: All other kinds begin with one of these and have a digit or an @.
PATTERN = rf"(?=[\p{{L}}\p{{N}}+(])(?:{TOKEN}|{'|'.join(PREFIXES.values())})|{NAME}"
MARKED = "[0-9@]"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is worked out once, however often it is named in there."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _entities(text: Column) -> Column:
    """All finds. Texts without digit and @ can only have names, which one pass of a simpler pattern shows."""
    full, names = (F.regexp_extract_all(text, F.lit(p), F.lit(0)) for p in (PATTERN, NAME))
    return F.when(text.rlike(MARKED), full).when(text.isNotNull(), names).otherwise(F.array().cast("array<string>"))


def _kind(e: Column) -> Column:
    """The kind of a find, told from its characters."""
    return (
        F.when(F.instr(e, "@") > 0, "email")
        .when(e.rlike(f"^(?:{TOKEN})$"), "token")
        .when(e.rlike(r"^[A-Z]{2}[0-9]{2}"), "iban")
        .when(e.rlike(r"^[0-9A-Fa-f]{32,64}$") & e.rlike("[A-Fa-f]"), "secret")
        .when(e.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$"), "ip")
        .when(e.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "ssn")
        .when(~e.rlike("[0-9]"), "name")
        .when(e.rlike(rf"^(?:{PREFIXES['card']})$"), "card")
        .otherwise("phone")
    )


def _normal(kind: Column, e: Column) -> Column:
    """What mentions of one entity have in common; names have their surnames' parts in common instead."""
    return F.when(kind == "phone", F.regexp_replace(e, "[^0-9+]", "")).when(kind.isin("card", "ssn"), F.regexp_replace(e, "[^0-9]", "")).when(kind == "iban", F.regexp_replace(e, " ", "")).when(kind == "token", e).otherwise(F.lower(e))


def _surname(e: Column) -> Column:
    """The surname of a name's mention."""
    return F.substring_index(e, " ", -1)


def _base(part: Column) -> Column:
    """What the forms of one part of a surname have in common."""
    plain = F.regexp_replace(part, "’", "'")
    return F.when(plain.rlike(FEMININE), F.regexp_replace(plain, "а$", "")).otherwise(F.regexp_replace(plain, "(?<=[сц]к)ая$", "ий"))


def _is_feminine(part: Column, gender: Column) -> Column:
    """Whether a part of a Cyrillic surname stands in its feminine form, or has one form and belongs to a woman."""
    return part.rlike(r"[\u0400-\u04FF]") & (part.rlike(FEMININE) | part.rlike("[сц]кая$") | (~part.rlike(MASCULINE) & (gender == "f")))


def _gender(e: Column) -> Column:
    """f or m, from the first name or title; '' without."""
    head = F.regexp_replace(F.substring_index(e, " ", 1), r"\.$", "")
    names = lambda g: [n for (_, of), found in FIRST_NAMES.items() if of == g for n in found] + TITLES[g]
    return F.when(F.instr(e, " ") == 0, "").when(head.isin(names("f")), "f").when(head.isin(names("m")), "m").otherwise("")


def _members(e: Column) -> Column:
    """The entities of a mention, as (kind, normal)."""
    one = lambda s: F.array(F.struct(s["kind"].alias("kind"), _normal(s["kind"], s["e"]).alias("normal")))
    parts = lambda s: F.transform(F.split(_surname(s["e"]), "-"), lambda p: F.struct(F.lit("surname").alias("kind"), _base(p).alias("normal")))
    return _let(F.struct(e.alias("e"), _kind(e).alias("kind")), lambda s: F.when(s["kind"] == "name", parts(s)).otherwise(one(s)))


def _bare(found: Column) -> Column:
    """A pattern for the surnames of a text's names standing alone, null without names; longer ones first."""
    surnames = F.transform(F.filter(found, lambda e: ~e.rlike("[0-9@]") & (F.instr(e, " ") > 0)), _surname)
    parts = F.flatten(F.transform(surnames, lambda s: F.concat(F.array(s), F.split(s, "-"))))
    forms = F.flatten(F.transform(parts, lambda p: F.when(p.rlike(FEMININE), F.array(p, _base(p))).when(p.rlike(MASCULINE), F.array(p, F.concat(p, F.lit("а")))).otherwise(F.array(p))))
    ordered = F.array_sort(F.array_distinct(forms), lambda a, b: F.length(b) - F.length(a))
    return F.when(F.size(surnames) > 0, F.concat(F.lit(r"(?<![\p{L}\p{N}])(?:"), F.array_join(ordered, "|"), F.lit(r")(?![\p{L}\p{N}])")))


def _hash(key: str, *parts: Column) -> Column:
    """60 bits of a keyed hash."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(key), *parts), 256), 1, 15), 16, 10).cast("long")


def _permuted(key: str, tweak: Column, digits: Column) -> Column:
    """A keyed permutation of the strings of as many decimal digits: halves are added to in turn."""
    return _let(F.struct(digits.alias("d"), F.length(digits).alias("n"), F.floor(F.length(digits) / 2).cast("int").alias("a"), tweak.alias("t")), lambda s: _network(key, s["t"], s["d"], s["n"], s["a"]))


def _network(key: str, tweak: Column, digits: Column, n: Column, a: Column) -> Column:
    low, high = F.pow(F.lit(10.0), a).cast("long"), F.pow(F.lit(10.0), n - a).cast("long")
    start = F.struct(F.substr(digits, F.lit(1), a).cast("long").alias("l"), F.substr(digits, a + 1, n - a).cast("long").alias("r"))

    def step(s: Column, k: Column) -> Column:
        even = k % 2 == 0
        return F.struct(
            F.when(even, F.pmod(s["l"] + _hash(key, tweak, n.cast("string"), k.cast("string"), s["r"].cast("string")), low)).otherwise(s["l"]).alias("l"),
            F.when(even, s["r"]).otherwise(F.pmod(s["r"] + _hash(key, tweak, n.cast("string"), k.cast("string"), s["l"].cast("string")), high)).alias("r"),
        )

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda s: F.concat(F.lpad(s["l"].cast("string"), a, F.lit("0")), F.lpad(s["r"].cast("string"), n - a, F.lit("0"))))


def _check_digit(body: Column) -> Column:
    """The digit that makes the sum of a card number come out right."""
    n = F.length(body)
    total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda s, k: s + _doubled(F.substr(body, k, F.lit(1)).cast("int"), (n - k) % 2 == 0))
    return F.pmod(10 - total % 10, F.lit(10))


def _doubled(digit: Column, yes: Column) -> Column:
    twice = digit * 2
    return F.when(yes, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(digit)


def _spelled(number: Column, length: int) -> Column:
    """Letters of a number to base 26."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    return F.concat(*[F.substr(F.lit(letters), (F.pmod(F.floor(number / F.lit(26**k)), F.lit(26)) + 1).cast("int"), F.lit(1)) for k in range(length)])


def _pick(items: list[str], number: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, items)), (F.pmod(number, F.lit(len(items))) + 1).cast("int"))


def _phone(key: str, normal: Column, attempt: Column) -> Column:
    """A country code or trunk 0 stays, so that both forms of a number go together; a 555 exchange stays one for the
    first attempts."""
    code = F.regexp_extract(normal, COUNTRY, 0)
    return _let(F.struct(code.alias("code"), F.substr(normal, F.length(code) + 1).alias("rest")), lambda s: _numbered(key, s["code"], s["rest"], attempt))


def _numbered(key: str, code: Column, rest: Column, attempt: Column) -> Column:
    tweak = F.concat(F.lit("phone"), attempt.cast("string"))
    fictional = _let(_permuted(key, tweak, F.concat(F.substring(rest, 1, 3), F.substring(rest, 7, 4))), lambda free: F.concat(F.substring(free, 1, 3), F.lit("555"), F.substring(free, 4, 4)))
    return F.concat(code, F.when((F.length(rest) == 10) & (F.substring(rest, 4, 3) == "555") & (attempt < 8), fictional).otherwise(_permuted(key, tweak, rest)))


def _card(key: str, normal: Column, attempt: Column) -> Column:
    body = F.substr(normal, F.lit(1), F.length(normal) - 1)
    off = F.substr(normal, F.length(normal), F.lit(1)).cast("int") - _check_digit(body)
    return _let(_permuted(key, F.concat(F.lit("card"), attempt.cast("string")), body), lambda new: F.concat(new, F.pmod(_check_digit(new) + off, F.lit(10)).cast("string")))


def _address(key: str, normal: Column, attempt: Column) -> Column:
    return _let(F.split(normal, r"\."), lambda parts: _octets(key, parts, attempt))


def _octets(key: str, parts: Column, attempt: Column) -> Column:
    value = lambda i: F.get(parts, F.lit(i)).cast("long")
    start = F.struct((value(0) * 256 + value(1)).alias("l"), (value(2) * 256 + value(3)).alias("r"))
    tweak = F.concat(F.lit("ip"), attempt.cast("string"))

    def step(s: Column, k: Column) -> Column:
        even = k % 2 == 0
        return F.struct(F.when(even, F.pmod(s["l"] + _hash(key, tweak, k.cast("string"), s["r"].cast("string")), F.lit(65536))).otherwise(s["l"]).alias("l"), F.when(even, s["r"]).otherwise(F.pmod(s["r"] + _hash(key, tweak, k.cast("string"), s["l"].cast("string")), F.lit(65536))).alias("r"))

    octet = lambda x: [F.floor(x / 256).cast("long"), x % 256]
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda s: F.concat_ws(".", *[x.cast("string") for x in [*octet(s["l"]), *octet(s["r"])]]))


def _email(key: str, normal: Column, attempt: Column) -> Column:
    own = _let(_hash(key, F.lit("email"), attempt.cast("string"), normal), lambda h: F.concat(_spelled(h, 10), F.lit("."), F.lpad(F.pmod(F.shiftright(h, 47), F.lit(100)).cast("string"), 2, "0")))
    domain = _let(_hash(key, F.lit("domain"), F.substring_index(normal, "@", -1)), lambda h: _spelled(h, 6))
    return F.concat(own, F.lit("@"), domain, F.lit(".example.org"))


def _secret(key: str, normal: Column, attempt: Column) -> Column:
    h = F.concat(F.sha2(F.concat_ws("|", F.lit(key), F.lit("secret"), attempt.cast("string"), normal), 256))
    return F.substr(h, F.lit(1), F.length(normal))


def _iban(key: str, normal: Column, attempt: Column) -> Column:
    digits = F.concat(*[F.lpad(_hash(key, F.lit(f"iban{k}"), attempt.cast("string"), normal).cast("string"), 18, "0") for k in range(2)])
    return F.concat(F.substring(normal, 1, 2), F.substr(digits, F.lit(1), F.length(normal) - 2))


def _token(key: str, normal: Column, attempt: Column) -> Column:
    """What a service's keys begin with, then characters of the same kinds."""
    head = F.coalesce(*[F.nullif(F.regexp_extract(normal, f"^{t}$", 1), F.lit("")) for t in TOKENS], F.lit(""))

    def spelled(s: Column) -> Column:
        def letter(ch: Column, at: Column) -> Column:
            h = _hash(key, F.lit("token"), attempt.cast("string"), normal, at.cast("string"))
            pick = lambda of: F.substr(F.lit(of), (F.pmod(h, F.lit(len(of))) + 1).cast("int"), F.lit(1))
            return F.when(ch.rlike("[0-9]"), pick("0123456789")).when(ch.rlike("[A-Z]"), pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ")).when(ch.rlike("[a-z]"), pick("abcdefghijklmnopqrstuvwxyz")).otherwise(ch)

        return F.concat(s["head"], F.array_join(F.transform(F.filter(F.split(s["rest"], ""), lambda ch: ch != ""), letter), ""))

    return _let(F.struct(head.alias("head"), F.substr(normal, F.length(head) + 1).alias("rest")), spelled)


def _surname_of(key: str, normal: Column, attempt: Column) -> Column:
    """A surname of the same script; each attempt has a syllable more, so that surnames never run out."""
    more = F.transform(F.sequence(F.lit(0), attempt.cast("int") + 1), lambda k: _hash(key, F.lit("syllable"), attempt.cast("string"), k.cast("string"), normal))
    made = {}
    for script, (starts, middles, ends) in SYLLABLES.items():
        made[script] = lambda s, a=starts, m=middles, z=ends: F.concat(_pick(a, s["h"]), F.array_join(F.transform(s["more"], lambda x: _pick(m, x)), ""), _pick(z, F.shiftright(s["h"], 12)))
    return _let(F.struct(_hash(key, F.lit("surname"), attempt.cast("string"), normal).alias("h"), more.alias("more")), lambda s: F.when(normal.rlike(r"[\u0400-\u04FF]"), made["cyrillic"](s)).otherwise(made["latin"](s)))


def _first_names(key: str) -> dict[str, str]:
    """A keyed cycle through the first names of each script and gender: none stands for itself."""
    out = {}
    for (script, gender), names in FIRST_NAMES.items():
        order = sorted(names, key=lambda n: hashlib.sha256(f"{key}|first|{script}|{gender}|{n}".encode()).digest())
        out |= dict(zip(order, order[1:] + order[:1]))
    return out


_SURROGATES: dict[str, Callable[[str, Column, Column], Column]] = {
    "phone": _phone, "card": _card, "ip": _address, "email": _email, "secret": _secret, "iban": _iban, "surname": _surname_of, "token": _token,
    "ssn": lambda key, normal, attempt: _permuted(key, F.concat(F.lit("ssn"), attempt.cast("string")), normal),
}


def surrogate(key: str, kind: Column, normal: Column, attempt: Column) -> Column:
    """The attempt-th surrogate of an entity, in normal form."""
    out = F.lit(None).cast("string")
    for name, make in _SURROGATES.items():
        out = F.when(kind == name, make(key, normal, attempt)).otherwise(out)
    return out


def _laid_out(kind: Column, e: Column, new: Column) -> Column:
    """The surrogate in the layout of the mention: separators where they were, capitals if all were."""
    numbers = F.aggregate(
        F.split(e, ""),
        F.struct(F.lit("").alias("out"), F.when(new.startswith("+"), 2).otherwise(1).alias("at")),
        lambda s, ch: F.when(ch.rlike("^[0-9A-Z]$"), F.struct(F.concat(s["out"], F.substr(new, s["at"], F.lit(1))).alias("out"), (s["at"] + 1).alias("at"))).otherwise(F.struct(F.concat(s["out"], ch).alias("out"), s["at"].alias("at"))),
        lambda s: s["out"],
    )
    return F.when(kind.isin("phone", "card", "ssn", "iban"), numbers).when(kind.isin("email", "secret") & (e == F.upper(e)), F.upper(new)).otherwise(new)


def _named(kind: Column, normal: Column) -> Column:
    return F.concat(kind, F.lit(":"), normal)


def exceptions(docs: DataFrame, key: str, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(the entities of each text, the entities that need another than their first surrogate with its number)."""
    found = docs.select(F.md5(F.col(text)).alias("same"), F.explode(_entities(F.col(text))).alias("e")).select("same", F.explode(_members(F.col("e"))).alias("m"))
    mentions = cut(found.select("same", "m.kind", "m.normal").distinct())
    entities = mentions.select("kind", "normal").distinct().withColumn("attempt", F.lit(0))
    made = lambda df: cut(df.withColumn("new", surrogate(key, F.col("kind"), F.col("normal"), F.col("attempt"))))
    given = made(entities)
    originals = given.select("kind", F.col("normal").alias("new")).withColumn("taken", F.lit(True))
    for _ in range(ATTEMPTS):
        # the first in order of attempts keeps a surrogate: settled entities are never moved again
        best = given.groupBy("kind", "new").agg(F.min(F.struct("attempt", "normal")).alias("keeps"), F.count(F.lit(1)).alias("n"))
        shared = given.join(best.where("n > 1"), ["kind", "new"]).where("keeps.normal <> normal").select("kind", "normal")
        real = given.join(originals, ["kind", "new"], "left_semi").select("kind", "normal")
        bad = cut(shared.union(real).distinct())
        if bad.isEmpty():
            return mentions, given.where("attempt > 0").select("kind", "normal", "attempt")
        moved = given.join(bad, ["kind", "normal"], "left_semi").select("kind", "normal", (F.col("attempt") + 1).alias("attempt"))
        given = cut(given.join(bad, ["kind", "normal"], "left_anti").unionByName(made(moved)))
    raise ValueError("a kind of entity has more members than surrogates")


def replace(docs: DataFrame, key: str, text: str = "text", count: str | None = "n_entities") -> DataFrame:
    """`docs` with the entities of column `text` replaced under the secret `key`, and their number in column `count` if named."""
    if not key:
        raise ValueError("a secret key is needed")
    mentions, again = exceptions(docs, key, text)
    own = [c for c in docs.columns if c != count]
    rows = docs.select(F.struct(*own).alias("__row"), F.col(text).alias("__text"))
    attempts: Callable[[Column, Column], Column] = lambda kind, normal: F.lit(0)
    if not again.isEmpty():
        # only texts with an exceptional entity; one row for each different text, with the few entities it has
        fixes = mentions.join(again, ["kind", "normal"]).groupBy("same").agg(F.map_from_entries(F.collect_set(F.struct(_named(F.col("kind"), F.col("normal")), "attempt"))).alias("__again"))
        fixes = cut(fixes)
        if fixes.agg(F.coalesce(F.sum(F.size("__again")), F.lit(0))).first()[0] <= SENT_ENTITIES:
            fixes = F.broadcast(fixes)
        rows = rows.withColumn("__same", F.md5("__text")).join(fixes.withColumnRenamed("same", "__same"), "__same", "left")
        attempts = lambda kind, normal: F.coalesce(F.col("__again")[_named(kind, normal)], F.lit(0))
    firsts = F.create_map(*[F.lit(x) for pair in _first_names(key).items() for x in pair])

    def of(kind: Column, normal: Column) -> Column:
        return surrogate(key, kind, normal, attempts(kind, normal))

    def surname(part: Column, gender: Column) -> Column:
        new = _let(_base(part), lambda base: _surname_of(key, base, attempts(F.lit("surname"), base)))
        return F.concat(new, F.when(_is_feminine(part, gender), "а").otherwise(""))

    def name(e: Column, found: Column) -> Column:
        """First name or title, then the parts of the surname; a bare surname has the gender that the text gives it."""
        inner = lambda s: F.concat(
            F.coalesce(F.concat(F.element_at(firsts, F.rtrim(s["head"])), F.lit(" ")), s["head"]),
            F.array_join(F.transform(F.split(s["surname"], "-"), lambda p: surname(p, s["gender"])), "-"),
        )
        told = F.exists(found, lambda x: (_surname(x) == _surname(e)) & (_gender(x) == "f"))
        gender = F.when(F.instr(e, " ") == 0, F.when(told, "f").otherwise("")).otherwise(_gender(e))
        return _let(F.struct(F.substr(e, F.lit(1), F.length(e) - F.length(_surname(e))).alias("head"), _surname(e).alias("surname"), gender.alias("gender")), inner)

    def new(e: Column, found: Column) -> Column:
        """The kind first, then the normal form, then the surrogate, then its layout."""
        normal = lambda kind: F.struct(e.alias("e"), kind.alias("kind"), _normal(kind, e).alias("normal"))
        made = lambda s: F.struct(s["e"].alias("e"), s["kind"].alias("kind"), of(s["kind"], s["normal"]).alias("new"))
        other = _let(_let(_let(_kind(e), normal), made), lambda s: _laid_out(s["kind"], s["e"], s["new"]))
        return F.when(e.rlike("[0-9@]"), other).otherwise(name(e, found))

    def cuts(s: Column) -> Column:
        """Finds and the gaps between them. A text with names is looked through once more, for their surnames alone."""
        whole = F.concat(F.lit(PATTERN + "|"), s["bare"])
        found = F.when(s["bare"].isNotNull(), F.regexp_extract_all(s["text"], whole, F.lit(0))).otherwise(s["found"])
        gaps = F.when(s["bare"].isNotNull(), F.split(s["text"], whole, -1)).when(s["text"].rlike(MARKED), F.split(s["text"], PATTERN, -1)).otherwise(F.split(s["text"], NAME, -1))
        return F.struct(s["text"].alias("text"), found.alias("found"), F.when(F.size(s["found"]) > 0, gaps).alias("gaps"))

    def rewritten(s: Column) -> Column:
        """Text and number of finds; the finds are worked out once and looked at from here."""
        joined = F.concat(F.array_join(F.zip_with(F.slice(s["gaps"], 1, F.size(s["found"])), F.transform(s["found"], lambda e: new(e, s["found"])), lambda gap, e: F.concat(gap, e)), ""), F.element_at(s["gaps"], -1))
        return F.struct(F.when(F.size(s["found"]) > 0, joined).otherwise(s["text"]).alias("text"), F.size(s["found"]).cast("long").alias("n"))

    once = _let(F.struct(F.col("__text").alias("text"), _entities(F.col("__text")).alias("found")), lambda s: F.struct(s["text"].alias("text"), s["found"].alias("found"), _bare(s["found"]).alias("bare")))
    rows = rows.select("__row", _let(_let(once, cuts), rewritten).alias("__out"))
    return rows.select(*[F.col("__out.text").alias(c) if c == text else F.col(f"__row.`{c}`").alias(c) for c in own], *([F.col("__out.n").alias(count)] if count else []))
