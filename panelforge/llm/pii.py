"""PII: detected entities get keyed surrogates of their kind, gender, script and format, distinct and consistent.

DataFrame functions only: no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import materialise, spread_join

# Titles before a name, by the gender they tell.
MALE = ("Mr", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "Don", "Sir", "господин", "Господин")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Doña", "госпожа", "Госпожа")
NEUTRAL = ("Dr", "Prof")

# Country calling codes of one and two digits; all others have three.
CALLING = (
    "1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "51", "52", "53", "54", "55", "56",
    "57", "58", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91", "92", "93", "94", "95", "98",
)

_TITLES = "|".join((*MALE, *FEMALE, *NEUTRAL))
#: Titles in capitals come before names in capitals only, of two words at most: what follows may be shouted text. Those
#: that are more often something else in capitals are none.
_SHOUTED = "|".join(sorted({t.upper() for t in (*MALE, *FEMALE, *NEUTRAL)} - {"MS", "DON"}))
_NAME = r"\p{Lu}[\p{L}'’-]+"
_SHOUTED_NAME = rf"(?!(?:{_SHOUTED})(?!\p{{L}}))\p{{Lu}}[\p{{Lu}}'’-]+(?!\p{{Ll}})"
_HEX = "[0-9A-Fa-f]{1,4}"
#: Kind and pattern; the first kind whose pattern matches the whole mention is its kind.
KINDS: tuple[tuple[str, str], ...] = (
    ("email", r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}_%+-][\p{L}\p{N}._%+-]{0,63}@(?:[\p{L}\p{N}-]{1,63}\.){1,8}\p{L}{2,24}"),
    ("ip", r"(?<![\p{N}.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\p{N}]|\.\d)"),
    ("iban", r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])"),
    ("ssn", r"(?<![\p{N}-])\d{3}-\d{2}-\d{4}(?![\p{N}-])"),
    ("phone", r"(?<![\p{L}\p{N}])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?!\p{N})|(?<![\p{L}\p{N}+])\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}(?!\p{N})|(?<![\p{L}\p{N}+.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\p{N}-])"),
    ("card", r"(?<![\p{L}\p{N}.-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{5})(?![\p{L}\p{N}])"),
    ("ip6", rf"(?<![\p{{L}}\p{{N}}:.])(?:(?:{_HEX}:){{7}}{_HEX}|(?:{_HEX}(?::{_HEX}){{0,5}})?::{_HEX}(?::{_HEX}){{0,5}}|{_HEX}(?::{_HEX}){{0,6}}::)(?![\p{{L}}\p{{N}}:])"),
    ("name", rf"(?<![\p{{L}}\p{{N}}])(?:(?:{_TITLES})\.? {_NAME}(?: {_NAME}){{0,2}}|(?:{_SHOUTED})\.? {_SHOUTED_NAME}(?: {_SHOUTED_NAME})?)"),
)
ANY = "|".join(f"(?:{p})" for _, p in KINDS)
#: Every match of ANY holds an @, a digit, two colons, or a title before a capital; most texts hold none and are told so
#: cheaply.
POSSIBLE = rf"[@0-9]|::|(?=[MHSDFPГг])(?:{_TITLES}|{_SHOUTED})\.? \p{{Lu}}"

# The letters that stand for hexadecimal digits in surrogates, by script, and the syllables of names.
_LATIN, _CYRILLIC, _GREEK = "abdeghiklmnoprst", "абвгдежзиклмнопр", "αβγδεζηθικλμνξοπ"
_SYLLABLES = ("ba", "be", "da", "de", "el", "fa", "ga", "ha", "ka", "la", "ma", "ne", "ra", "sa", "ta", "vi")
_SYLLABLES_CYRILLIC = ("ба", "бе", "да", "де", "ел", "фа", "га", "ха", "ка", "ла", "ма", "не", "ра", "са", "та", "ви")
_ENDINGS = {"m": ("rick", "ander"), "f": ("lina", "essa"), "n": ("ley", "is"), "s": ("mann", "son")}
_ENDINGS_CYRILLIC = {"m": ("слав", "мир"), "f": ("лина", "ена"), "n": ("ша", "ня"), "s": ("ский", "енко")}

#: After so many tries with the entity's own length surrogates grow, by GROWTH digits a try (addresses take the whole
#: IPv4 range first, then the documentation range of IPv6), so that a crowded format never runs out; after MAX_TRIES
#: an error says so.
TRIES, GROWTH, MAX_TRIES = 3, 2, 24

#: A capitalised word, for mentions without a title of names found in the same text; a genitive's ending stays.
_WORD = rf"(?<![\p{{L}}\p{{N}}]){_NAME}"
_TITLED = rf"^(?:{_TITLES}|{_SHOUTED})\.? "
_GENITIVE = r"['’][sS]$"


def _kind(mention: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, pattern in reversed(KINDS):
        # a mention by itself meets any look-around at its borders
        out = F.when(mention.rlike(f"^(?:{pattern})$"), F.lit(name)).otherwise(out)
    return out


def _digits(h: Column, salt: int) -> Column:
    """48 decimal digits from a sha256 in hex."""
    wide = lambda at: F.substring(F.lpad(F.conv(F.substring(h, at, 14), 16, 10), 20, "0"), -12, 12)
    return F.concat(*[wide(1 + 14 * k + salt) for k in range(4)])


def _hash(key: str, kind: Column, norm: Column, attempt: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), kind, norm, attempt.cast("string")).cast("binary"), 256)


def _reshaped(form: Column, h: Column) -> Column:
    """``form`` with letters and digits replaced, each by one of its script and case; all else stays."""
    pick = lambda alphabet, i: F.substr(F.translate(h, "0123456789abcdef", alphabet), i % 64 + 1, F.lit(1))
    digits = _digits(h, 0)

    def one(c: Column, i: Column) -> Column:
        low = F.lower(c)
        letter = F.when(low.rlike(r"\p{IsCyrillic}"), pick(_CYRILLIC, i)).when(low.rlike(r"\p{IsGreek}"), pick(_GREEK, i)).otherwise(pick(_LATIN, i))
        return F.when(c.rlike(r"\p{N}"), F.substr(digits, i % 48 + 1, F.lit(1))).when(c.rlike(r"\p{L}"), F.when(c == low, letter).otherwise(F.upper(letter))).otherwise(c)

    return F.array_join(F.transform(F.split(form, ""), one), "")


def _filled(form: Column, plain: Column, slot) -> Column:
    """``form`` with the characters that are a ``slot`` replaced in order by those of ``plain``; what is left of it follows."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("n"))

    def step(acc: Column, c: Column) -> Column:
        here = slot(c)
        return F.struct(F.concat(acc["out"], F.when(here, F.substr(plain, acc["n"] + 1, F.lit(1))).otherwise(c)).alias("out"), (acc["n"] + here.cast("int")).alias("n"))

    return F.aggregate(F.split(form, ""), start, step, lambda acc: F.concat(acc["out"], F.substr(plain, acc["n"] + 1, F.length(plain))))


def _luhn(digits: Column) -> Column:
    """The sum that Luhn's check takes modulo 10."""
    number = lambda c: c.try_cast("int")
    doubled = lambda c: (number(c) * 2) % 10 + F.when(number(c) >= 5, 1).otherwise(0)
    each = F.transform(F.reverse(F.split(digits, "")), lambda c, i: F.when(i % 2 == 1, doubled(c)).otherwise(number(c)))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x)


def _mod97(text: Column) -> Column:
    """The remainder of an account number's digits, letters counting from 10, that ISO 7064 checks."""
    value = lambda c: F.coalesce(c.try_cast("int"), F.ascii(c) - 55)
    step = lambda acc, c: (acc * F.when(c.rlike("[0-9]"), 10).otherwise(100) + value(c)) % 97
    return F.aggregate(F.split(F.upper(text), ""), F.lit(0), step)


def _syllables(h: Column, script: Column, ending: Column, n: Column) -> Column:
    latin, cyrillic = F.array(*map(F.lit, _SYLLABLES)), F.array(*map(F.lit, _SYLLABLES_CYRILLIC))
    at = lambda i: F.conv(F.substr(h, i + 1, F.lit(1)), 16, 10).cast("int") + 1
    one = lambda i: F.when(script == "c", F.element_at(cyrillic, at(i))).otherwise(F.element_at(latin, at(i)))
    stem = F.array_join(F.transform(F.sequence(F.lit(0), n - 1), one), "")
    pairs = lambda table: F.coalesce(*[F.when(ending == k, F.when(at(F.lit(40)) > 8, F.lit(e[0])).otherwise(F.lit(e[1]))) for k, e in table.items()])
    return F.initcap(F.concat(stem, F.when(script == "c", pairs(_ENDINGS_CYRILLIC)).otherwise(pairs(_ENDINGS))))


def _surrogate(key: str, attempt: int) -> Column:
    """The surrogate norm of (kind, norm, gender, script) at an attempt."""
    kind, norm = F.col("kind"), F.col("norm")
    h = _hash(key, kind, F.concat_ws("|", norm, "gender"), F.lit(attempt))
    digits = _digits(h, 0)
    more = GROWTH * max(0, attempt - TRIES + 1)
    longer = F.substring(h, 50, 8) if attempt >= TRIES else F.lit("")
    local, domain = F.substring_index(norm, "@", 1), F.substring_index(norm, "@", -1)
    dh = F.sha2(F.concat_ws("|", F.lit(key), F.lit("domain"), domain).cast("binary"), 256)
    top = F.element_at(F.array(F.lit("com"), F.lit("org"), F.lit("net")), F.conv(F.substring(dh, 20, 1), 16, 10).cast("int") % 3 + 1)
    email = F.concat(_reshaped(local, h), longer, F.lit("@d"), F.substring(dh, 1, 6), F.lit(".example."), top)
    octet = lambda k: (F.conv(F.substring(h, k, 4), 16, 10).cast("int") % 254 + 1).cast("string")
    if attempt < 2 * TRIES:
        ip = F.concat_ws(".", F.lit("10") if attempt < TRIES else octet(13), octet(1), octet(5), octet(9))
    else:
        ip = F.concat_ws(":", F.lit("2001:db8"), *[F.substring(h, k, 4) for k in (1, 5, 9, 13, 17, 21)])
    n = F.length(norm) + more
    # beyond the digits of one hash those of a second follow; numbers are matched up to 40 digits long
    digits = F.concat(digits, _digits(F.sha2(F.concat(h, F.lit("+")).cast("binary"), 256), 0))
    plain = F.substr(digits, F.lit(1), n)
    # a country's code stays, or the first digit where none is written
    kept = F.when(norm.startswith("+"), F.regexp_extract(norm, rf"^\+(?:{'|'.join(CALLING)}|\d{{1,3}})", 0)).otherwise(F.substring(norm, 1, 1))
    phone = F.concat(kept, (F.substring(digits, 1, 1).cast("int") % 8 + 2).cast("string"), F.substr(digits, F.lit(2), n - F.length(kept) - 1))
    body = F.concat(F.substring(norm, 1, 1), F.substr(digits, F.lit(1), n - 2))
    check = (10 - _luhn(F.concat(body, F.lit("0"))) % 10) % 10
    valid = _luhn(norm) % 10 == 0
    card = F.when(valid, F.concat(body, check.cast("string"))).otherwise(F.concat(body, F.when(F.substring(digits, 40, 1).cast("int") == check, (check + 1) % 10).otherwise(F.substring(digits, 40, 1).cast("int")).cast("string")))
    ssn = F.concat(F.lit("9"), F.substr(digits, F.lit(1), n - 1))
    account = F.concat(_reshaped(F.substr(norm, F.lit(5), F.length(norm)), h), F.substr(digits, F.lit(1), F.lit(more)))
    pair = 98 - _mod97(F.concat(account, F.substring(norm, 1, 2), F.lit("00")))
    pair = F.when(_mod97(F.concat(F.substr(norm, F.lit(5), F.length(norm)), F.substring(norm, 1, 4))) == 1, pair).otherwise(F.when(pair == 98, 2).otherwise(pair + 1))
    iban = F.concat(F.substring(norm, 1, 2), F.lpad(pair.cast("string"), 2, "0"), account)
    ip6 = F.concat_ws(":", F.lit("2001:db8"), *[F.substring(h, k, 4) for k in (1, 5, 9, 13, 17, 21)])
    one_name = lambda part, i: _syllables(F.when(i == 0, h).otherwise(F.sha2(F.concat(h, i.cast("string")).cast("binary"), 256)), F.col("script"), F.col("gender"), F.lit(2 + min(attempt, 20)))
    name = F.array_join(F.transform(F.split(norm, "-"), one_name), "-")  # as many parts as the name has
    return (
        F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "phone", phone).when(kind == "card", card)
        .when(kind == "ssn", ssn).when(kind == "iban", iban).when(kind == "ip6", ip6).when(kind.isin("given", "surname"), name).otherwise(plain)
    )


def _norm() -> Column:
    """What makes two mentions of a kind the same entity: letters in lower case, or the digits alone, a phone number's plus
    with them."""
    form, kind = F.col("form"), F.col("kind")
    return F.when(kind == "email", F.lower(form)).when(kind == "ip", form).when(kind == "ip6", F.lower(form)).when(kind == "iban", F.regexp_replace(form, " ", "")).when(kind == "phone", F.regexp_replace(form, r"[^+0-9]", "")).otherwise(F.regexp_replace(form, r"[^0-9]", ""))


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(kind, norm, gender, surrogate) of distinct (kind, norm, gender, script).

    In each round every entity still without one proposes; of those with the same proposal the smallest norm has it,
    unless it is taken or is itself an entity of the corpus. Surrogates are so distinct within a kind, and never a
    real entity. From TRIES rounds on proposals grow, so each round leaves fewer; after MAX_TRIES rounds an error is raised.
    """
    real = materialise(entities, "entities")
    pending, taken = real, None
    given = real.select("kind", F.lower("norm").alias("same")).distinct()
    for attempt in range(MAX_TRIES):
        offer = pending.withColumn("surrogate", _surrogate(key, attempt)).withColumn("same", F.lower("surrogate"))
        first = offer.groupBy("kind", "same").agg(F.min(F.struct("norm", "gender", "surrogate")).alias("x")).select("kind", "same", "x.*")
        won = first.join(given, ["kind", "same"], "left_anti")
        if taken is not None:
            won = won.join(taken.select("kind", "same"), ["kind", "same"], "left_anti")
        won = materialise(won.select("kind", "norm", "gender", "surrogate", "same"), "surrogates")
        taken = won if taken is None else taken.unionByName(won)
        pending = materialise(pending.join(won.select("kind", "norm", "gender"), ["kind", "norm", "gender"], "left_anti"), "pending")
        if pending.isEmpty():
            return taken.select("kind", "norm", "gender", "surrogate")
    raise RuntimeError(f"entities are left without a surrogate after {MAX_TRIES} rounds")


def replace_entities(docs: DataFrame, *, key: str = "panelforge", text_col: str = "text") -> DataFrame:
    """``docs`` with ``text_col`` rewritten and ``n_entities`` added; all other columns stay.

    Mentions are matched in the whole text, leftmost first: e-mail, IPv4 and IPv6 addresses, IBANs, SSNs, phone and card
    numbers, names after a title (in capitals, MS and DON aside: title and up to two words), and further mentions, without one, of the
    words of these names in the same text, in capitals too. Not found: names without any titled mention in their text.
    An IPv6 address is told from others by its spelling and becomes one of the documentation range.

    Equal entities get equal surrogates in all documents, however they are written (case of an address, separators of
    a number, a name's words one by one); distinct ones get distinct ones. Format, case, script, a name's hyphens, a phone
    number's country code and whether a card number or an IBAN passes its check are kept. A given name is one entity for each gender its titles tell: after a neutral title, or
    none, it takes the gender of its first gendered mention in the text, else is neutral.

    Texts without a match pass through untouched and unshuffled; the others, long ones too, are written to the shared
    folder with a row number, and only their mentions are shuffled. A third of all rows with one entity is one entity,
    and its mentions are dealt over many tasks when the map is joined. Null text stays null with n_entities 0; repeated rows are
    rewritten each; null ids matter nothing; a column n_entities is replaced; an empty table gives no row.
    """
    names = [c for c in docs.columns if c != "n_entities"]
    docs = docs.select(*names)
    text = F.col(f"`{text_col}`")
    holds = F.coalesce(text.rlike(POSSIBLE) & text.rlike(ANY), F.lit(False))
    untouched = docs.where(~holds).withColumn("n_entities", F.lit(0))
    either = f"{ANY}|(?:{_WORD})"
    first = F.regexp_extract_all(text, F.lit(ANY), F.lit(0))
    titled = F.exists("found", lambda x: x.rlike(_TITLED))
    source = docs.where(holds).select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("doc"), first.alias("found"), F.monotonically_increasing_id().alias("row"))
    inner = F.col("doc")[text_col]
    # texts with a titled name are matched again, capitalised words included
    source = source.withColumn("titled", titled).withColumn("found", F.when(F.col("titled"), F.regexp_extract_all(inner, F.lit(either), F.lit(0))).otherwise(F.col("found")))
    found = materialise(source, "found")

    mentions = found.select("row", F.posexplode("found").alias("pos", "form")).withColumn("kind", F.coalesce(_kind(F.col("form")), F.lit("word")))
    parts = materialise(_parts(mentions), "parts")
    mapped = surrogates(parts.select("kind", "norm", "gender", "script").groupBy("kind", "norm", "gender").agg(F.min("script").alias("script")), key)
    placed = spread_join(parts, mapped, ["kind", "norm", "gender"], ["row", "pos"], "inner")
    # by mention: its words in order; then by row
    new = placed.groupBy("row", "pos").agg(F.min("lead").alias("lead"), F.sort_array(F.collect_list(F.struct("at", _written().alias("w")))).alias("words"))
    joined = F.concat(F.col("lead"), F.array_join(F.transform("words", lambda x: x["w"]), " "))
    lists = new.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("pos", joined.alias("new")))).alias("news"))
    between = F.split(inner, ANY, -1)
    between = F.when(F.col("titled"), F.split(inner, either, -1)).otherwise(between)
    news = F.transform("found", lambda form, i: F.coalesce(F.element_at("news", i), form))
    new_text = F.array_join(F.zip_with(between, news, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    touched = found.join(lists, "row").select(*[new_text.alias(c) if c == text_col else F.col("doc")[c].alias(c) for c in names], F.size("news").alias("n_entities"))
    return untouched.unionByName(touched)


def _parts(mentions: DataFrame) -> DataFrame:
    """(row, pos, at, lead, form, tail, kind, norm, gender, script) of each entity: a name has one for each of its words.

    ``lead`` is what stands before the entity in its mention (a title), ``tail`` what follows it (a genitive's ending)."""
    others = mentions.where("kind not in ('name', 'word')").select(
        "row", "pos", F.lit(0).alias("at"), F.lit("").alias("lead"), "form", F.lit("").alias("tail"), "kind", _norm().alias("norm"), F.lit("n").alias("gender"), F.lit("l").alias("script")
    )
    title = F.regexp_extract("form", _TITLED, 0)
    words = mentions.where("kind = 'name'").withColumn("lead", title).select("row", "pos", "lead", F.split(F.expr("substr(form, length(lead) + 1)"), " ").alias("words"))
    words = words.select("row", "pos", "lead", F.size("words").alias("n"), F.posexplode("words").alias("at", "whole"))
    bare = F.regexp_replace(F.trim("lead"), r"\.$", "")
    among = lambda titles: F.upper(bare).isin(*[t.upper() for t in titles])
    gender = F.when(among(MALE), "m").when(among(FEMALE), "f").otherwise("n")
    last = F.col("at") == F.col("n") - 1
    words = words.select("row", "pos", "at", "lead", *_split_genitive(), F.when(last, "surname").otherwise("given").alias("kind"), F.when(last, "s").otherwise(gender).alias("gender"))
    words = words.withColumn("norm", F.lower("form"))
    # of each text: the gender that a given name's first gendered mention tells, and what each spelling stands for
    told = words.where("gender in ('m', 'f')").groupBy("row", "norm").agg(F.min_by("gender", F.struct("pos", "at")).alias("told"))
    words = words.join(told, ["row", "norm"], "left").withColumn("gender", F.when(F.col("gender") == "n", F.coalesce("told", F.lit("n"))).otherwise(F.col("gender"))).drop("told")
    spelled = words.groupBy("row", F.col("norm").alias("same")).agg(F.min_by(F.struct("kind", "norm", "gender"), F.struct("pos", "at")).alias("e")).select("row", "same", "e.*")
    bare = mentions.where("kind = 'word'").select("row", "pos", F.lit(0).alias("at"), F.lit("").alias("lead"), F.col("form").alias("whole")).select("row", "pos", "at", "lead", *_split_genitive())
    untitled = bare.withColumn("same", F.lower("form")).join(spelled, ["row", "same"])
    columns = ["row", "pos", "at", "lead", "form", "tail", "kind", "norm", "gender"]
    named = words.select(*columns).unionByName(untitled.select(*columns))
    return others.unionByName(named.withColumn("script", F.when(F.col("form").rlike(r"\p{IsCyrillic}"), "c").otherwise("l")))


def _split_genitive() -> list[Column]:
    tail = F.regexp_extract("whole", _GENITIVE, 0)
    return [F.regexp_replace("whole", _GENITIVE, "").alias("form"), tail.alias("tail")]


def _written() -> Column:
    """The surrogate as its entity is written: separators, spaces and capitals as in ``form``."""
    form, kind, surrogate = F.col("form"), F.col("kind"), F.col("surrogate")
    shouted = (F.length(form) > 1) & (form == F.upper(form))
    name = F.concat(F.when(shouted, F.upper(surrogate)).otherwise(surrogate), "tail")
    return (
        F.when(kind.isin("phone", "card", "ssn"), _filled(form, F.regexp_replace(surrogate, r"\+", ""), lambda c: c.rlike(r"\d")))
        .when(kind == "iban", _filled(form, surrogate, lambda c: c != " "))
        .when(kind.isin("given", "surname"), name)
        .otherwise(surrogate)
    )
