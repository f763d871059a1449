"""PII surrogates: keyed, type-consistent, distinct replacements; column expressions only.

1. **Mentions.** One pattern finds e-mail addresses, IPv4 and IPv6 addresses,
   card and social-security numbers, IBANs, phone numbers, and persons (a title
   and one to four names, or a known given name and one to three more; after
   them their surnames alone in the same document). Every repeat in it is
   bounded or possessive and no match can begin inside a run of letters or
   digits, so the time is linear in the text, whatever the text is. It is
   matched against each document once; the mentions are written with it.
2. **Canonical values.** A mention is cut into pieces: a person's title stays as
   it is, given name and surname are pieces of their own kinds, an address is
   its local part and its domain. A piece's canonical value leaves out its
   spelling: case, the separators of a number, the country code of a North
   American phone number. So ``Dr. Mary Jones``, ``MARY JONES`` and ``Ms Jones``
   stay the same person, and ``(415) 555-2671`` and ``+1 415 555 2671`` one number.
   A person whose name says no gender has that of any title of theirs in the document.
3. **Surrogates.** For every distinct ``(kind, canonical value)`` of the corpus a
   surrogate of its kind is derived from SHA-256 over key, kind, value and
   attempt: names of the same script and gender from a list, later attempts
   from syllables; numbers digit by digit, with the country code, the numbering
   plan, the octet ranges and valid check digits (Luhn, modulo 97) kept.
4. **Collision check.** Two values never share a surrogate, and no surrogate
   is a value that the corpus has: whatever collides tries again with the next
   attempt, those of fewer attempts first, until none does. The check is a
   two-phase aggregate and a join over distinct values, nothing is collected.
   Where a format is so full that values are left after ``ROUNDS`` rounds, these
   are lengthened by a number of their own and so are distinct from all others.
5. **Replacement.** Documents without a mention pass by. The others are split
   at their mentions and put together again with the surrogates, each written
   in its mention's own format, joined by value (a value that a third of all
   documents mention is one skewed key that adaptive execution splits).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillrank.llm.common import Scratch

#: Titles by gender, and names by script and gender.
TITLES = {"m": ["Mr", "Herr", "Monsieur", "Señor", "Sr", "г-н", "господин"], "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "г-жа", "госпожа"], "n": ["Dr", "Prof"]}
#: Upper-case forms of Latin titles are titles too.
GIVEN = {
    "lm": ["James", "Robert", "Michael", "William", "David", "Richard", "Joseph", "Thomas", "Charles", "Daniel", "Matthew", "Anthony", "Stefan", "Jürgen", "Pierre", "Jacques", "Carlos", "Miguel", "Javier", "Klaus"],
    "lf": ["Mary", "Patricia", "Jennifer", "Linda", "Elizabeth", "Barbara", "Susan", "Jessica", "Sarah", "Karen", "Nancy", "Margaret", "Ursula", "Sabine", "Camille", "Monique", "Carmen", "Dolores", "Beatriz", "Ingrid"],
    "cm": ["Иван", "Сергей", "Дмитрий", "Андрей", "Алексей", "Николай", "Михаил", "Виктор", "Павел", "Юрий"],
    "am": ["محمد", "أحمد", "علي", "حسن", "حسين", "خالد", "يوسف", "إبراهيم"],
    "af": ["فاطمة", "عائشة", "مريم", "زينب", "خديجة", "ليلى", "نور", "سارة"],
    "cf": ["Мария", "Анна", "Елена", "Ольга", "Наталья", "Татьяна", "Ирина", "Светлана", "Галина", "Юлия"],
}
#: Given names that are found besides those of the surrogates.
KNOWN = {
    "m": "John Paul Mark George Kenneth Steven Edward Brian Ronald Kevin Jason Jeffrey Ryan Jacob Gary Nicholas Eric Jonathan Stephen Larry Justin Scott Brandon Benjamin Samuel Gregory Alexander Patrick Jack Dennis Jerry Tyler Aaron Jose Adam Nathan Henry Peter Zachary Kyle Walter Ethan Jeremy Harold Keith Christian Roger Noah Gerald Carl Terry Sean Arthur Austin Christopher Andrew Joshua Donald Timothy Luis Juan Pedro Pablo Diego Antonio Manuel Francisco Hans Karl Heinz Wolfgang Uwe Dieter Matthias Andreas Tobias Jean Michel Philippe Louis Nicolas Olivier Giovanni Marco Luca Mohammed Ahmed Ali Omar José Jesús Ángel Andrés Raúl Ramón Martín Joaquín Sebastián René André François Jérôme Frédéric Rémi Björn Jörg Günter Günther Alex Владимир Александр Максим Игорь Олег Пётр Роман Антон Борис Василий Константин".split(),
    "f": "Lisa Betty Sandra Ashley Kimberly Emily Donna Michelle Carol Amanda Melissa Deborah Stephanie Rebecca Sharon Laura Cynthia Dorothy Amy Kathleen Angela Shirley Emma Brenda Pamela Nicole Anna Samantha Katherine Christine Debra Rachel Carolyn Janet Catherine Maria Heather Diane Ruth Julie Olivia Joyce Virginia Victoria Kelly Lauren Christina Joan Evelyn Judith Megan Andrea Cheryl Hannah Jacqueline Martha Gloria Teresa Ann Anne Sara Madison Frances Kathryn Janice Alice Julia Jane Sophia Ana Lucia Isabel Elena Petra Monika Heike Gisela Renate Claudia Marie Sophie Isabelle Nathalie Fatima Aisha María Lucía Sofía Inés Mónica Verónica Hélène Chloé Zoé Amélie Käthe Екатерина Людмила Анастасия Нина Валентина Вера Надежда Дарья Марина Оксана Ксения Виктория".split(),
}
SURNAMES = {
    "l": ["Smith", "Johnson", "Brown", "Miller", "Wilson", "Taylor", "Anderson", "Walker", "Mitchell", "Campbell", "Schneider", "Fischer", "Weber", "Wagner", "Dubois", "Moreau", "Laurent", "Garcia", "Fernandez", "Romero"],
    "a": ["الحسن", "العلي", "المصري", "الخطيب", "حداد", "نجار", "صالح", "منصور"],
    "c": ["Иванов", "Петров", "Смирнов", "Кузнецов", "Соколов", "Лебедев", "Козлов", "Новиков", "Морозов", "Волков"],
}
#: Family and given names of one or two characters, and names that are written family name first in Latin.
HAN = {"family": "王李张刘陈杨黄赵吴周徐孙马朱胡郭何林", "given": "伟芳娜敏静丽强磊军洋勇艳杰涛明超兰霞平刚玲文华建国志红英"}
PINYIN = {"family": "Wang Li Zhang Liu Chen Yang Huang Zhao Wu Zhou Xu Sun Zhu Gao Lin".split(), "given": "Wei Fang Na Min Jing Lei Jun Yong Jie Tao Ming Chao Xia Ping Gang Hua Xin Yan Ying".split()}
SYLLABLES = {"a": ["با", "دا", "را", "سا", "ما", "نا", "لا", "كا", "فا", "ها", "بي", "دي", "ري", "سي", "مي", "ني"], "l": ["ba", "do", "fe", "gi", "ka", "lo", "mi", "na", "po", "ra", "se", "ti", "vo", "wa", "ze", "lu"], "c": ["ба", "до", "фе", "ги", "ка", "ло", "ми", "на", "по", "ра", "се", "ти", "во", "ва", "зе", "лу"]}
ENDINGS = {"am": "ن", "af": "ة", "a": "ي", "lm": "n", "lf": "na", "cm": "н", "cf": "на", "l": "n", "c": "в"}

_TITLES = {t for ts in TITLES.values() for t in ts}
_TITLE = "(?:" + "|".join(sorted(_TITLES | {t.upper() for t in _TITLES if t.isascii() and len(t) < 5}, key=len, reverse=True)) + r")\.?"
_WORD = r"(?:(?:Mc|Mac|[ODL]['’])(?=\p{Lu}))?+\p{Lu}\p{Ll}++"
_NAME = rf"{_WORD}(?:-{_WORD})?+"
_CAPS = r"(?:[ODL]['’])?+\p{Lu}{2,}+(?:-\p{Lu}{2,}+)?+"
_STOP = "The|This|That|These|Those|And|But|Or|If|In|On|At|He|She|It|They|We|You|His|Her|Our|Is|Was|Has|Had|Will|Can|When|Then|Der|Die|Das|Und|Er|Sie|Le|La|Les|Et|Il|Elle|El|Los|Las|Он|Она|Они|Это"
_STOPS = "|".join([_STOP, _STOP.upper(), "OF|TO|FOR|WITH|FROM|BY|AS|ARE|NOT|DO|NO"])
_MORE = rf"(?: (?!(?:{_STOP})(?!\p{{L}})){_NAME})"
_MORE_CAPS = rf"(?: (?!(?:{_STOPS})(?!\p{{L}})){_CAPS})"
_LISTED = [n for which, ns in (*GIVEN.items(), *KNOWN.items()) if which[0] != "a" for n in ns]
_GIVEN = "(?:" + "|".join(_LISTED) + ")"
_GIVEN_CAPS = "(?:" + "|".join(dict.fromkeys(n.upper() for n in _LISTED if len(n) > 2)) + ")"
_ARABIC = r"\p{IsArabic}{2,24}+"
#: A capitalized word alone; where it is the surname of a person found before, it is replaced.
BARE = rf"(?<![\p{{L}}'’-])(?:{_CAPS}(?!\p{{L}})|{_NAME})(?![\p{{L}}-])"
_HEX = "[0-9A-Fa-f]{1,4}"
#: Repeats are bounded by what the formats allow: 64 characters before the @, 63 a label.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}+@(?:[A-Za-z0-9-]{1,63}+\.){1,32}[A-Za-z]{2,63}+",
    "ipv4": r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?![\w]|\.\d)",
    "ipv6": rf"(?<![\w:.])(?:(?:{_HEX}:){{7}}{_HEX}|(?=[0-9A-Fa-f:]{{0,40}}\d){_HEX}(?::{_HEX}){{0,5}}::(?:{_HEX}(?::{_HEX}){{0,5}})?)(?![\w:])",
    "card": r"(?<![\w.+-])(?:(?:\d{4}[ -]?){3}\d{1,4}|\d{4}[ -]\d{6}[ -]\d{5})(?![\w-])",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b",
    "phone": r"(?<![\w.+-])(?:(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]\d{4}|\+\d{7,15}(?![\w-])|\+\d(?:(?:[ .-]|[ .-]?\(|\)[ .-]?)?\d){6,14}|\+\d{1,3}(?:[ .-]\d{2,4}){2,4}|1?[2-9][0-8]\d[2-9]\d{6})(?![\w-])",
    "han": rf"(?<!\p{{IsHan}})[{HAN['family']}]\p{{IsHan}}{{1,2}}(?=先生|女士|小姐|(?!\p{{IsHan}}))",
    "listing": rf"(?m)(?:^|(?<=[;:(] |[;:(])){_NAME}, {_GIVEN}(?=[ \t]?(?:[;)]|$))(?-m)",
    "person": rf"(?<![\p{{L}}'’])(?:(?=[\p{{Lu}}г])(?:{_TITLE} (?:{_CAPS}{_MORE_CAPS}{{0,3}}|{_NAME}{_MORE}{{0,3}})|(?={_NAME} \p{{Lu}}){_GIVEN}{_MORE}{{1,3}}|(?:{'|'.join(PINYIN['family'])}) (?:{'|'.join(PINYIN['given'])})|(?=\p{{Lu}}{{2}}){_GIVEN_CAPS}{_MORE_CAPS}{{1,3}})|(?:{'|'.join(GIVEN['am'] + GIVEN['af'])})(?: {_ARABIC}){{1,2}})(?!\p{{L}})",
}
PII = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: Rounds of the collision check, each of which leaves a small share of the one before; what is left then is lengthened.
ROUNDS = 40
#: Attempts in an IPv4 address's own octet lengths; later ones have three digits each, as short formats have few addresses.
WIDE = 8


def _kind(value: Column) -> Column:
    out = F.lit("person")
    for kind in reversed([k for k in PATTERNS if k not in ("person", "listing", "han")]):
        out = F.when(value.rlike(f"^(?:{PATTERNS[kind]})$"), kind).otherwise(out)
    return F.when(value.rlike(r"^\p{IsHan}+$"), "han").otherwise(out)


def _isin(value: Column, *names: str) -> Column:
    return value.isin([n.lower() for which in names for n in ({**GIVEN, **KNOWN}[which])])


def _persons(mention: DataFrame) -> DataFrame:
    """``mention (row, at, mention)`` with its kind and, for persons, title, name and gender.

    A given name's gender is the list's, else its title's, else that of a title
    with the same names in the document, else what its ending suggests.
    """
    kind = _kind(F.col("mention"))
    title = F.when(F.col("kind") == "person", F.regexp_extract("mention", f"^{_TITLE} ", 0)).otherwise("")
    df = mention.withColumn("kind", kind).withColumn("title", title).withColumn("name", F.substr("mention", F.length("title") + 1))
    swapped = F.col("name").contains(", ")
    parts = F.when(swapped, F.reverse(F.split("name", ", "))).otherwise(F.split("name", " "))
    df = df.withColumn("swapped", swapped).withColumn("names", F.when(F.col("kind") == "person", parts)).withColumn("given", F.when(F.size("names") > 1, F.lower(F.col("names")[0])))
    word = F.lower(F.regexp_replace("title", r"[. ]+$", ""))
    titled = F.when(word.isin([t.lower() for t in TITLES["f"]]), "f").when(word.isin([t.lower() for t in TITLES["m"]]), "m")
    same = Window.partitionBy("row", "given", F.lower(F.element_at("names", -1)))
    listed = F.when(_isin(F.col("given"), "lf", "cf", "af", "f"), "f").when(_isin(F.col("given"), "lm", "cm", "am", "m"), "m")
    df = df.withColumn("titled", titled)
    told = F.when(F.col("given").isNotNull(), F.min("titled").over(same))
    return df.withColumn("gender", F.coalesce(listed, "titled", told, F.when(F.col("given").rlike("[aаة]$"), "f").otherwise("m")))


def _canonical(kind: Column, value: Column) -> Column:
    """What two spellings of one value have in common."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    american = (F.length(digits) == 11) & digits.startswith("1")
    phone = F.when(american, F.substr(digits, F.lit(2))).when(value.startswith("+"), F.concat(F.lit("+"), digits)).otherwise(digits)
    return (F.when(kind == "phone", phone).when(kind == "card", digits).when(kind == "iban", F.replace(value, F.lit(" "), F.lit("")))
            .when(kind.isin("ssn", "ipv4", "han"), value).otherwise(F.lower(value)))


def _pieces() -> Column:
    """A mention's pieces ``(kind, value, canon)``; kind null for what stays as it is."""
    def piece(kind: Column, part: Column) -> Column:
        kind = kind.cast("string")
        return F.struct(kind.alias("kind"), part.alias("value"), F.when(kind.isNotNull(), _canonical(kind, part)).alias("canon"))

    value, none = F.col("mention"), F.lit(None)
    script = F.when(F.col("name").rlike(r"\p{IsCyrillic}"), "c").when(F.col("name").rlike(r"\p{IsArabic}"), "a").otherwise("l")
    given = F.concat(F.lit("given_"), script, F.col("gender"))
    surname = F.concat(F.lit("surname_"), script)
    # the last name is the surname, all before it are given names; a listing has the surname first
    named = F.transform("names", lambda w, i: F.when(i < F.size("names") - 1, F.array(piece(given, w), piece(none, F.lit(" ")))).otherwise(F.array(piece(surname, w))))
    listing = F.array(piece(surname, F.col("names")[1]), piece(none, F.lit(", ")), piece(given, F.col("names")[0]))
    person = F.when(F.col("swapped"), listing).otherwise(F.concat(F.array(piece(none, F.col("title"))), F.flatten(named)))
    email = F.array(piece(F.lit("email"), F.substring_index(value, "@", 1)), piece(none, F.lit("@")), piece(F.lit("domain"), F.substring_index(value, "@", -1)))
    out = F.when(F.col("kind") == "email", email).when(F.col("kind") == "person", person).otherwise(F.array(piece(F.col("kind"), value)))
    return F.filter(out, lambda p: p["value"].isNotNull() & (p["value"] != ""))


def _written(kind: Column, value: Column, surrogate: Column) -> Column:
    """A surrogate in the spelling of the mention: its case, its separators, its country code."""
    def filled(i: Column) -> Column:
        c = F.substr(value, i, F.lit(1))
        rest = F.length(F.regexp_replace(F.substr(value, i), "[^A-Za-z0-9]", ""))
        new = F.when(rest <= F.length(plain), F.substr(plain, F.length(plain) - rest + 1, F.lit(1))).otherwise(c)
        return F.when(~c.rlike("[A-Za-z0-9]"), c).when(c.rlike("[A-Z]"), F.upper(new)).otherwise(new)

    plain = F.regexp_replace(surrogate, "[^A-Za-z0-9]", "")
    longer = F.length(plain) > F.length(F.regexp_replace(value, "[^A-Za-z0-9]", ""))
    spelled = F.when(longer, surrogate).otherwise(F.array_join(F.transform(F.sequence(F.lit(1), F.length(value)), filled), ""))
    cased = F.when((F.upper(value) == value) & (F.length(value) > 1), F.upper(surrogate)).otherwise(F.initcap(surrogate))
    return F.when(kind.startswith("given_") | kind.startswith("surname_"), cased).when(kind.isin("domain", "ipv4", "han"), surrogate).otherwise(spelled)


def _number(seed: Column, at: Column) -> Column:
    """The ``at``-th of the keyed stream of numbers, 0 to 65535."""
    return F.conv(F.substr(F.sha2(F.concat(seed, F.lit("/"), F.floor(at / 15).cast("string")), 256), (at % 15) * 4 + 1, F.lit(4)), 16, 10).cast("int")


def _spelled(value: Column, seed: Column) -> Column:
    """Each letter and digit replaced by one of its class, everything else kept."""
    def one(i: Column) -> Column:
        c, n = F.substr(value, i, F.lit(1)), _number(seed, i)
        small = F.substr(F.lit("abcdefghijklmnopqrstuvwxyz"), n % 26 + 1, F.lit(1))
        return (F.when(c.rlike("[0-9]"), (n % 10).cast("string")).when(c.rlike("[a-z]"), small).when(c.rlike("[A-Z]"), F.upper(small)).otherwise(c))

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(value)), one), "")


def _luhn(value: Column) -> Column:
    """Luhn sum of a number's digits modulo 10."""
    digits = F.reverse(F.split(F.regexp_replace(value, "[^0-9]", ""), ""))
    twice = F.transform(F.filter(digits, lambda d: d != ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(twice, F.lit(0), lambda a, x: a + x) % 10


def _card(value: Column, seed: Column) -> Column:
    """Digits replaced, the first one kept; a valid check digit stays valid and a wrong one wrong."""
    plain = F.concat(F.substr(value, F.lit(1), F.lit(1)), _spelled(F.substr(value, F.lit(2)), seed))
    body = F.substr(plain, F.lit(1), F.length(plain) - 1)
    wanted = (F.lit(10) - _luhn(F.concat(body, F.lit("0")))) % 10
    return F.concat(body, F.when(_luhn(value) == 0, wanted).otherwise((wanted + 1 + _number(seed, F.lit(99)) % 9) % 10).cast("string"))


def _ipv4(value: Column, seed: Column, wide: Column) -> Column:
    """Octets of the same number of digits (``wide``: of three), within 0 to 255; no network or broadcast address."""
    def octet(o: Column, i: Column) -> Column:
        n, size = _number(seed, i), F.when(wide, 3).otherwise(F.length(o))
        return F.when(size == 1, n % 9 + 1).when(size == 2, n % 90 + 10).otherwise(F.when(i == 0, n % 124 + 100).otherwise(n % 155 + 100)).cast("string")

    return F.array_join(F.transform(F.split(value, r"\."), octet), ".")


def _ipv6(value: Column, seed: Column) -> Column:
    """Hexadecimal digits replaced: digits by digits, letters by letters of the same case."""
    def one(i: Column) -> Column:
        c, n = F.substr(value, i, F.lit(1)), _number(seed, i)
        small = F.substr(F.lit("abcdef"), n % 6 + 1, F.lit(1))
        return F.when(c == ":", c).when(c.rlike("[0-9]"), (n % 10).cast("string")).when(c.rlike("[a-f]"), small).otherwise(F.upper(small))

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(value)), one), "")


def _phone(value: Column, seed: Column) -> Column:
    """Country code and first digit after it kept; numbers of the North American plan stay within it."""
    code = F.regexp_extract(value, r"^\+(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{1,3})", 0)
    abroad = F.concat(code, F.substr(value, F.length(code) + 1, F.lit(1)), _spelled(F.substr(value, F.length(code) + 2), seed))
    n = [_number(seed, F.lit(i)) for i in range(10)]
    american = F.concat(*[(x % 8 + 2 if i in (0, 3) else x % 9 if i == 1 else x % 10).cast("string") for i, x in enumerate(n)])
    return F.when(value.startswith("+"), abroad).when(value.rlike(r"^[2-9][0-8]\d[2-9]\d{6}$"), american).otherwise(_spelled(value, seed))


def _mod97(value: Column) -> Column:
    """An IBAN's number modulo 97, letters being 10 to 35 (its first four characters go last)."""
    moved = F.concat(F.substr(value, F.lit(5)), F.substr(value, F.lit(1), F.lit(4)))

    def step(acc: Column, c: Column) -> Column:
        return F.when(c.rlike("[0-9]"), (acc * 10 + F.ascii(c) - 48) % 97).when(c.rlike("[A-Z]"), (acc * 100 + F.ascii(c) - 55) % 97).otherwise(acc)

    return F.aggregate(F.split(moved, ""), F.lit(0), step)


def _iban(value: Column, seed: Column) -> Column:
    """Country kept; valid check digits stay valid and wrong ones wrong."""
    country, rest = F.substr(value, F.lit(1), F.lit(2)), _spelled(F.substr(value, F.lit(5)), seed)
    check = F.lit(98) - _mod97(F.concat(country, F.lit("00"), rest))
    check = F.when(_mod97(value) == 1, check).otherwise((check - 2 + 1 + _number(seed, F.lit(99)) % 96) % 97 + 2)
    return F.concat(country, F.lpad(check.cast("string"), 2, "0"), rest)


def _domain(value: Column, seed: Column) -> Column:
    """A keyed label under the reserved name ``example``, with the same top-level domain."""
    letters = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(8)), lambda i: F.substr(F.lit("abcdefghijklmnopqrstuvwxyz"), _number(seed, i) % 26 + 1, F.lit(1))), "")
    return F.concat(letters, F.lit(".example."), F.substring_index(value, ".", -1))


def _listed(names: list[str], script: str, ending: str, seed: Column, attempt: Column) -> Column:
    pick = F.element_at(F.array(*[F.lit(n.lower()) for n in names]), _number(seed, F.lit(0)) % len(names) + 1)
    syllables = F.array(*map(F.lit, SYLLABLES[script]))
    made = F.array_join(F.transform(F.sequence(F.lit(1), attempt + 1), lambda i: F.element_at(syllables, _number(seed, i) % len(SYLLABLES[script]) + 1)), "")
    return F.when(attempt == 0, pick).otherwise(F.concat(made, F.lit(ending)))


def _han(value: Column, seed: Column) -> Column:
    """A family name and as many given characters as the name has."""
    def one(i: Column) -> Column:
        return F.when(i == 1, F.substr(F.lit(HAN["family"]), _number(seed, i) % len(HAN["family"]) + 1, F.lit(1))).otherwise(F.substr(F.lit(HAN["given"]), _number(seed, i) % len(HAN["given"]) + 1, F.lit(1)))

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(value)), one), "")


def _surrogate(key: str) -> Column:
    kind, value, attempt = F.col("kind"), F.col("value"), F.col("attempt")
    seed = F.sha2(F.concat_ws("\x1f", F.lit(key), kind, value, attempt.cast("string")), 256)
    local = F.concat(_spelled(value, seed), F.when(attempt > 20, attempt.cast("string")).otherwise(F.lit("")))
    out = F.when(kind == "email", local).when(kind == "domain", _domain(value, seed)).when(kind == "ipv4", _ipv4(value, seed, attempt > WIDE)).when(kind == "card", _card(value, seed))
    out = out.when(kind == "phone", _phone(value, seed)).when(kind == "iban", _iban(value, seed)).when(kind == "ipv6", _ipv6(value, seed)).when(kind == "han", _han(value, seed))
    for which, names in GIVEN.items():
        out = out.when(kind == f"given_{which}", _listed(names, which[0], ENDINGS[which], seed, attempt))
    for which, names in SURNAMES.items():
        out = out.when(kind == f"surname_{which}", _listed(names, which, ENDINGS[which], seed, attempt))
    return out.otherwise(_spelled(value, seed))


def _lengthened(judged: DataFrame) -> DataFrame:
    """Surrogates of values whose format has no room left: their last attempt with a number of their own.

    The number, of more digits than any value or surrogate of the kind has
    characters, makes them longer than all others, and it is another for each.
    """
    longest = judged.groupBy("kind").agg(F.max(F.greatest(F.length("value"), F.length("surrogate"))).alias("longest"))
    own = F.lpad((F.monotonically_increasing_id() + 1).cast("string"), F.greatest("longest", F.lit(20)) + 1, "0")
    return judged.where("again").join(longest, "kind").select("kind", "value", F.concat("surrogate", own).alias("surrogate"))


def surrogates(values: DataFrame, key: str, scratch: Scratch, rounds: int = ROUNDS) -> DataFrame:
    """``(kind, value, surrogate)`` of distinct ``values(kind, value)``: one to one within a kind, none a value of it."""
    settled = scratch.save(values.select("kind", "value", F.lit(0).alias("attempt")).withColumn("surrogate", _surrogate(key)), "attempts")
    for _ in range(max(1, rounds)):
        first = settled.groupBy("kind", "surrogate").agg(F.min(F.struct("attempt", "value")).alias("w"), F.count("*").alias("n")).where("n > 1").select("kind", "surrogate", F.col("w.value").alias("winner"))
        real = settled.select("kind", F.col("value").alias("surrogate"), F.lit(True).alias("real"))
        seen = settled.join(first, ["kind", "surrogate"], "left").join(real, ["kind", "surrogate"], "left")
        again = F.coalesce("real", F.lit(False)) | F.coalesce(F.col("winner") != F.col("value"), F.lit(False))
        judged = scratch.save(seen.select("kind", "value", "attempt", "surrogate", again.alias("again")), "judged")
        if not judged.where("again").limit(1).count():
            break
        moved = judged.where("again").select("kind", "value", (F.col("attempt") + 1).alias("attempt")).withColumn("surrogate", _surrogate(key))
        settled = scratch.save(judged.where("NOT again").select("kind", "value", "attempt", "surrogate").unionByName(moved), "attempts")
    else:
        whole = scratch.save(judged.where("NOT again").select("kind", "value", "surrogate").unionByName(_lengthened(judged)), "whole")
        scratch.drop("attempts", "judged")
        return whole
    scratch.drop("attempts")
    return judged.select("kind", "value", "surrogate")


def replace_pii(docs: DataFrame, key: str, text: str = "text", count: str = "n_pii") -> DataFrame:
    """``docs`` with every mention in ``text`` replaced, and the number of mentions in the column ``count``.

    All other columns stay (one named as ``count`` is replaced). A null text stays
    null and an empty one empty, with 0 mentions. Repeated rows get the same
    surrogates and stay repeated. An empty table gives an empty one.
    """
    if not key:
        raise ValueError("a key is needed")
    scratch = Scratch(docs.sparkSession, "pii")
    kept = [c for c in docs.columns if c != count]
    docs = docs.select(*[F.col(f"`{c}`") for c in kept])
    mentions = F.coalesce(F.regexp_extract_all(F.col(f"`{text}`").cast("string"), F.lit(PII), F.lit(0)), F.array().cast("array<string>"))
    found = scratch.save(docs.select(F.struct("*").alias("doc"), mentions.alias("mentions")), "found")
    clean = found.where(F.size("mentions") == 0).select("doc.*").withColumn(count, F.lit(0).cast("long"))

    hit = found.where(F.size("mentions") > 0).select(F.monotonically_increasing_id().alias("row"), "doc", "mentions")
    hit = scratch.save(hit, "hit")
    body = F.col("doc")[text].cast("string")
    mention = _persons(hit.select("row", F.posexplode("mentions").alias("at", "mention")))
    pieces = mention.select("row", "at", F.posexplode(_pieces()).alias("part", "piece")).select("row", "at", "part", "piece.kind", "piece.value", "piece.canon")
    pieces = scratch.save(pieces, "pieces")
    table = surrogates(pieces.where("kind IS NOT NULL").select("kind", F.col("canon").alias("value")).distinct(), key, scratch)
    table = table.select("kind", F.col("value").alias("canon"), "surrogate")
    written = F.coalesce(_written(F.col("kind"), F.col("value"), F.col("surrogate")), "value")
    surname = F.when(F.col("kind").startswith("surname_"), F.col("canon"))
    put = pieces.join(table, ["kind", "canon"], "left").select("row", F.struct("at", "part", written.alias("s"), surname.alias("name"), F.when(surname.isNotNull(), F.col("surrogate")).alias("plain")).alias("p"))
    put = put.groupBy("row").agg(F.sort_array(F.collect_list("p")).alias("p"))
    known = F.filter("p", lambda x: x["name"].isNotNull())
    out = hit.join(put, "row").select("doc", "p", F.split(body, PII, -1).alias("plain"), known.alias("known"), F.transform(known, lambda x: x["name"]).alias("names"))

    def later(gap: Column, i: Column) -> Column:
        """A gap with the bare surnames of persons before it replaced, and their number."""
        def swap(w: Column) -> Column:
            at = F.array_position("names", F.lower(w))
            person = F.get("known", (at - 1).cast("int"))
            new = F.when(F.upper(w) == w, F.upper(person["plain"])).otherwise(F.initcap(person["plain"]))
            return F.struct(w.alias("w"), F.when((at > 0) & (person["at"] < i), new).alias("s"))

        found = F.transform(F.regexp_extract_all(gap, F.lit(BARE), F.lit(0)), swap)
        text = F.array_join(F.zip_with(F.split(gap, BARE, -1), found, lambda b, x: F.concat(b, F.coalesce(x["s"], x["w"], F.lit("")))), "")
        return F.struct(text.alias("text"), F.size(F.filter(found, lambda x: x["s"].isNotNull())).alias("n"))

    as_is = F.transform("plain", lambda g: F.struct(g.alias("text"), F.lit(0).alias("n")))
    out = out.select("doc", "p", F.when(F.size("names") > 0, F.transform("plain", later)).otherwise(as_is).alias("gaps"))
    with_gap = F.transform(F.col("p"), lambda x: F.concat(F.when(x["part"] == 0, F.element_at("gaps", x["at"] + 1)["text"]).otherwise(F.lit("")), x["s"]))
    new = F.concat(F.array_join(with_gap, ""), F.element_at("gaps", -1)["text"])
    n = F.size("gaps") - 1 + F.aggregate("gaps", F.lit(0), lambda a, x: a + x["n"])
    out = out.select(F.col("doc").withField(f"`{text}`", new).alias("doc"), n.cast("long").alias(count))
    return out.select("doc.*", f"`{count}`").unionByName(clean)
