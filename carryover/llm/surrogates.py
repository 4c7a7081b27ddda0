"""Personal data replaced by keyed surrogates, in DataFrame functions only.

Detected: e-mail addresses, IPv4 addresses, phone numbers, card-like numbers,
national numbers (3-2-4 digits), account numbers (IBAN), secrets (long hex
strings, key-like values after ``token =`` and the like), names after a title,
and in the same row every whole-word repeat of such a full name or family name
that begins with a capital (single letters, which are initials, aside).  A surrogate is drawn from ``sha2(key, kind, entity, attempt)`` and keeps
what the original shows: length, punctuation and letter case, digits for
digits, valid octets, the country of an account, the first digit and the
check-digit validity of a card, top-level domains; names keep title, number
of words, script (Latin, Cyrillic, Greek) and the gender of the titles a given
name has in the table (neither, if they differ).

*Coreference*: mentions are reduced to an entity first (digits only, lower
case, secrets as they are unless they are one long hexadecimal number, single words of a name without a possessive ending), and each entity has one surrogate in the whole
table, whatever its spelling.  *Distinctness*: a surrogate must not be drawn
for two entities of a kind, nor be an entity of the table itself.  Draws that
collide are drawn again, all but the least entity of each collision, until
none is left; from the ninth attempt on a surrogate may be one character longer,
so a small space of formats cannot run out (octets aside).

At scale: one scan finds the mentions; distinct mentions and entities are
what is shuffled.  Rows without a mention are passed on without a shuffle;
rows with one are joined by ``(doc_id, text hash)``.  A mention that a third
of the rows share is one row per document in a sort-merge join, which Spark
splits.  Rounds of drawing are written to the shared folder.

Cases: null and empty texts and rows without a mention are returned as they
are, with 0 replaced; rows that repeat an id and a text are each returned;
null ids are kept; an empty table gives no rows; very long texts are whole (no pattern needs a
stack that grows with the text); all columns of the input are kept, whatever their
names (``__pii_`` names aside): where one is called ``n_replaced`` the count is ``n_replaced_``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

KEY = "carryover"

#: Titles (fixed values): male, female, either.
TITLES = {
    "m": ["Mr", "Sir", "Herr", "Herrn", "Señor", "Sr", "Monsieur", "Don", "господин", "Господин", "Κύριος", "Κύριο"],
    "f": ["Mrs", "Ms", "Miss", "Madam", "Frau", "Señora", "Señorita", "Sra", "Madame", "Mme", "Mlle", "Doña", "госпожа", "Госпожа", "Κυρία"],
    "u": ["Dr", "Prof", "Doctor", "Professor"],
}
#: Name syllables by script, and endings by gender (fixed values; any syllables will do).
SYLLABLES = {
    "latin": ["ba", "de", "ki", "lo", "mu", "ra", "se", "ti", "no", "vu", "fa", "ge", "li", "mo", "ru", "ta"],
    "cyrillic": ["ба", "де", "ки", "ло", "му", "ра", "се", "ти", "но", "ву", "фа", "ге", "ли", "мо", "ру", "та"],
    "greek": ["βα", "δε", "κι", "λο", "μυ", "ρα", "σε", "τι", "νο", "θυ", "φα", "γε", "λι", "μο", "ρυ", "τα"],
}
ENDINGS = {
    "latin": {"m": "n", "f": "na", "u": "l", "s": "ner"},
    "cyrillic": {"m": "н", "f": "на", "u": "л", "s": "нер"},
    "greek": {"m": "νος", "f": "να", "u": "λ", "s": "νερ"},
}

_TITLE = "|".join(sorted((t for ts in TITLES.values() for t in ts), key=len, reverse=True))
_INITIALS = "".join(sorted({t[0] for ts in TITLES.values() for t in ts}))
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
#: Secrets known by their form, and by a keyword before them: whole, however long (only a look-behind has bounds).
_BARE = (
    r"(?=[0-9a-fA-Fgs])(?<![\p{L}0-9])"
    r"(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+|AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{30,}+|sk-[A-Za-z0-9]{20,}+)(?![\p{L}0-9])"
)
_KEYED = (
    r"(?<=[=:\s\"'])(?=[A-Za-z_\-+/][A-Za-z_\-+/.]*+\d|\d)"
    r"(?<=(?i:token|secret|passwd|password|api[_-]?key|access[_-]?key)[\"']?\s{0,3}[=:]\s{0,3}[\"']?)[A-Za-z0-9_\-+/.]{8,}(?<!\.)={0,2}"
)
#: Kinds in the order in which they are tried at a place of the text; a value after a keyword goes
#: before what only its beginning may look like.
PATTERNS = {
    # one class for the domain: a repeated group would need a stack frame for each of its labels
    "email": r"(?<![\p{L}0-9._%+\-])[\p{L}0-9._%+\-]++@(?=[\p{L}0-9\-])[\p{L}0-9.\-]*(?<!\.)\.\p{L}{2,}",
    "secret": f"{_KEYED}|{_BARE}",
    "ip": rf"(?<![\d.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?\d)",
    "iban": r"(?<![\p{L}0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}0-9])",
    "ssn": r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])",
    "phone": (
        r"(?<![\p{L}\d.])\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .\-]?\d{2,4}){2,4}(?!\d)"
        r"|(?<![\p{L}\d.])(?:1[ .\-]?)?\(\d{3}\) ?\d{3}[ .\-]\d{4}(?!\d)"
        r"|(?<![\p{L}\d.\-])(?:(?:1[ .\-])?\d{3}[.\-]\d{3}[.\-]\d{4}|1 \d{3} \d{3} \d{4})(?![\d\-])"
    ),
    "card": r"(?<![\p{L}\d.\-])(?:\d{13,19}|\d{4}(?:[ \-]\d{4}){3})(?![\p{L}\d])",
    "name": rf"(?=[{_INITIALS}])(?<!\p{{L}})(?:{_TITLE})\.? \p{{Lu}}[\p{{L}}'’\-]*+(?: \p{{Lu}}[\p{{L}}'’\-]*+)*+",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: The end of a word of a name that is not the name's own.
_SUFFIX = r"(?:['’][sS]|['’\-]+)$"
#: All kinds but names hold a digit, an at sign or, as a secret may do without, one of these; quicker to look for.
_LETTERS = r"AKIA|gh[pousr]_|sk-|[a-f]{32}|[A-F]{32}"
_TOKENS = "|".join(f"(?:{p})" for k, p in PATTERNS.items() if k != "name")
_HEAD = rf"^(?:{_TITLE})\.? "
#: A secret that is a number, in whichever case its digits are.
_HEX = "^(?:[0-9a-f]{32,}|[0-9A-F]{32,})$"
_DIGIT_KINDS = ("phone", "card", "ssn")


def mentions_of(text: str) -> Column:
    return F.regexp_extract_all(F.col(text), F.lit(f"({ANY})"), F.lit(1))


def has_mention(text: str) -> Column:
    """Whether ``mentions_of`` finds any."""
    t = F.col(text)
    return F.coalesce(((t.rlike("[0-9@]") | t.rlike(_LETTERS)) & t.rlike(_TOKENS)) | t.rlike(PATTERNS["name"]), F.lit(False))


def own_names(hits: str) -> Column:
    """The full and family names among the mentions ``hits`` of a row, as alternatives of a pattern, the longest first."""
    name = F.expr(f"transform(filter({hits}, x -> x rlike {_sql('^(?:' + PATTERNS['name'] + ')$')}), x -> lower(regexp_replace(regexp_replace(x, {_sql(_HEAD)}, ''), {_sql(_SUFFIX)}, '')))")
    each = F.array_distinct(F.flatten(F.transform(name, lambda x: F.array(x, F.substring_index(x, " ", -1)))))
    ranked = F.array_sort(F.transform(F.filter(each, lambda x: F.length(x) > 1), lambda x: F.struct(-F.length(x), x.alias("name"))))
    return F.array_join(ranked["name"], "|")


def _any_or(own: Column) -> Column:
    """The pattern of all mentions of a row with the names ``own``."""
    return F.concat(F.lit(f"{ANY}|(?<!\\p{{L}})(?=\\p{{Lu}})(?iu:"), own, F.lit(")(?!\\p{L})"))


def _sql(text: str) -> str:
    """``text`` as a SQL string."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def kind_of(mention: Column) -> Column:
    """The kind of a whole mention; a value known by its context alone is a secret."""
    whole = lambda p: mention.rlike(f"^(?:{p})$")
    tried = [k for k in PATTERNS if k != "secret"]
    # without a digit or an at sign: a name, with a title or as a repeat without
    first = F.when(whole(_BARE), "secret").when(mention.rlike(r"^\p{Lu}[\p{L}'’\- ]*+$"), "name")
    return reduce(lambda w, k: w.when(whole(PATTERNS[k]), k), tried, first).otherwise("secret")


def _entity() -> Column:
    kind, m = F.col("kind"), F.col("mention")
    return (
        F.when(kind.isin(*_DIGIT_KINDS), F.regexp_replace(m, r"[^0-9]", ""))
        .when(kind == "iban", F.replace(m, F.lit(" "), F.lit("")))
        .when((kind == "secret") & ~m.rlike(_HEX), m)
        .otherwise(F.lower(m))
    )


def _pick(letters: str, at: str) -> str:
    """SQL: a letter of ``letters`` chosen by the seed and a place."""
    return f"substr('{letters}', 1 + CAST(pmod(xxhash64(seed, {at}), {len(letters)}) AS INT), 1)"


def _drawn() -> Column:
    """SQL over ``kind, entity, attempt, seed``: the surrogate of an entity."""
    lower = "abcdefghijklmnopqrstuvwxyz"
    digit = f"CASE WHEN c = '0' OR i > 0 THEN {_pick('0123456789', 'i')} ELSE {_pick('123456789', 'i')} END"
    chars = "split(entity, '')"
    alnum = (
        f"CASE WHEN c BETWEEN '0' AND '9' THEN {_pick('0123456789', 'i')} WHEN c BETWEEN 'a' AND 'z' THEN {_pick(lower, 'i')} "
        f"WHEN c BETWEEN 'A' AND 'Z' THEN {_pick(lower.upper(), 'i')} WHEN c BETWEEN 'а' AND 'я' THEN {_pick('абвгдежзиклмнопрстуфхцчшэюя', 'i')} "
        f"WHEN c BETWEEN 'α' AND 'ω' THEN {_pick('αβγδεζηθικλμνξοπρστυφχψω', 'i')} ELSE c END"
    )
    hexed = f"CASE WHEN c BETWEEN '0' AND '9' THEN {_pick('0123456789', 'i')} WHEN c BETWEEN 'a' AND 'f' THEN {_pick('abcdef', 'i')} ELSE c END"
    longer = f"if(attempt > 8, {_pick(lower, '-attempt')}, '')"
    longer_digit = f"if(attempt > 8, {_pick('0123456789', '-attempt')}, '')"
    join = "array_join(transform({of}, (c, i) -> {how}), '')"
    tld = r"regexp_extract(entity, '\\.[^.]+$', 0)"
    by_kind = {
        "email": f"concat({longer}, {join.format(of=f'split(left(entity, length(entity) - length({tld})), \'\')', how=alnum)}, {tld})",
        "ip": "array_join(transform(split(entity, '[.]'), (c, i) -> CAST(1 + pmod(xxhash64(seed, i), 254) AS STRING)), '.')",
        "iban": f"concat(left(entity, 2), {join.format(of='split(substr(entity, 3), \'\')', how=alnum)})",
        "secret": f"concat(if(entity rlike '^[0-9a-f]+$', {join.format(of=chars, how=hexed)}, {join.format(of=chars, how=alnum)}), {longer})",
        "ssn": f"concat({join.format(of=chars, how=digit)}, {longer_digit})",
        "phone": f"concat(left(entity, 1), {join.format(of='split(substr(entity, 2), \'\')', how=_pick('0123456789', 'i'))}, {longer_digit})",
    }
    body = f"concat(left(entity, 1), {join.format(of='split(substr(entity, 2, length(entity) - 2), \'\')', how=_pick('0123456789', 'i'))}, {longer_digit})"
    check = "CAST(pmod({want} - ({sum}), 10) AS STRING)"
    by_kind["card"] = f"transform(array({body}), b -> concat(b, {check.format(want=luhn('entity'), sum=luhn("concat(b, '0')"))}))[0]"
    for script, syllables in SYLLABLES.items():
        each = f"element_at(array({', '.join(repr(s) for s in syllables)}), 1 + CAST(pmod(xxhash64(seed, j), {len(syllables)}) AS INT))"
        for who, ending in ENDINGS[script].items():
            by_kind[f"name_{script}_{who}"] = f"concat(array_join(transform(sequence(1, 2 + CAST(attempt AS INT)), j -> {each}), ''), '{ending}')"
    return F.expr("CASE kind " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in by_kind.items()) + " END")


def luhn(digits: str) -> str:
    """SQL: the check sum (0..9) of a string of digits, 0 for a valid one."""
    doubled = "CASE WHEN pmod(n - i, 2) = 0 THEN (d * 2) % 10 + (d * 2) DIV 10 ELSE d END"
    each = f"transform(split(x, ''), (c, i) -> transform(array(CAST(c AS INT)), d -> transform(array(length(x)), n -> {doubled})[0])[0])"
    return f"pmod(transform(array({digits}), x -> aggregate({each}, CAST(0 AS BIGINT), (a, b) -> a + b))[0], 10)"


def _kin(kind: str) -> Column:
    """A kind without the gender of a given name."""
    return F.regexp_replace(kind, "_[mfu]$", "_g")


def surrogates(entities: DataFrame, key: str = KEY) -> DataFrame:
    """``kind, entity, surrogate`` for distinct ``kind, entity``: no surrogate twice in a
    kind, none that is an entity of that kind, nor for a given name of any gender."""
    entities = stored(entities.select("kind", "entity").distinct(), "entities")
    taken = entities.select(_kin("kind").alias("kin"), F.col("entity").alias("surrogate"))
    open_, done, attempt = entities, [], 0
    while True:
        seed = F.sha2(F.concat_ws("\x1f", F.lit(key), "kind", "entity", F.lit(str(attempt))), 256)
        drawn = open_.withColumn("attempt", F.lit(attempt)).withColumn("seed", seed).withColumn("surrogate", _drawn())
        first = drawn.groupBy("kind", "surrogate").agg(F.min("entity").alias("entity"))
        won = first.withColumn("kin", _kin("kind")).join(taken, ["kin", "surrogate"], "left_anti").select("kind", "entity", "surrogate")
        done.append(stored(won, "surrogates"))
        taken = taken.union(done[-1].select(_kin("kind"), "surrogate"))
        open_ = stored(open_.join(done[-1], ["kind", "entity"], "left_anti"), "open")
        if open_.isEmpty():
            return reduce(DataFrame.union, done)
        attempt += 1


def rendered(mentions: DataFrame, key: str = KEY) -> DataFrame:
    """``mention, replacement`` for a table of distinct ``mention``."""
    found = stored(mentions.withColumn("kind", kind_of(F.col("mention"))), "mentions")
    plain = found.where("kind <> 'name'").withColumn("entity", _entity())
    title = F.regexp_extract("mention", rf"^({_TITLE})\.? ", 1)
    script = F.when(F.col("word").rlike(r"^\p{IsCyrillic}"), "cyrillic").when(F.col("word").rlike(r"^\p{IsGreek}"), "greek").otherwise("latin")
    named = found.where("kind = 'name'").withColumn("words", F.split(F.regexp_replace("mention", _HEAD, ""), " "))
    named = named.withColumn("name", F.sha2("mention", 256))  # each word carries this, however long the name is
    words = named.select("name", title.alias("title"), F.size("words").alias("n"), F.posexplode("words").alias("pos", "word"))
    # a word of a name is a given name but for the last, which is the family name
    words = words.withColumn("kin", F.concat_ws("_", F.lit("name"), script, F.when(F.col("pos") == F.col("n") - 1, "s").otherwise("g")))
    words = words.withColumn("suffix", F.regexp_extract("word", _SUFFIX, 0)).withColumn("word", F.regexp_replace("word", _SUFFIX, ""))
    words = words.withColumn("entity", F.lower("word"))
    # one gender for each given name, by all its titles
    male, female = (F.coalesce(F.max(F.col("title").isin(TITLES[g])), F.lit(False)) for g in "mf")
    gender = F.when(male & ~female, "m").when(female & ~male, "f").otherwise("u")
    entities = words.groupBy("kin", "entity").agg(gender.alias("gender"))
    entities = entities.select(F.when(F.col("kin").endswith("_g"), F.regexp_replace("kin", F.lit("g$"), F.col("gender"))).otherwise(F.col("kin")).alias("kind"), "entity")
    drawn = stored(surrogates(plain.select("kind", "entity").union(entities), key), "drawn")

    poured = F.expr(
        "array_join(transform(sequence(1, length(mention)), i -> CASE WHEN substr(mention, i, 1) rlike '[0-9A-Za-z]' AND "
        "(kind <> 'iban' OR substr(mention, i, 1) <> ' ') THEN substr(surrogate, length(regexp_replace(left(mention, i), '[^0-9A-Za-z]', '')), 1) "
        "ELSE substr(mention, i, 1) END), '')"
    )
    tail = F.expr("substr(surrogate, 1 + length(regexp_replace(mention, '[^0-9A-Za-z]', '')))")
    cased = F.expr(
        "CASE WHEN upper(mention) = mention AND lower(mention) <> mention THEN upper(surrogate) WHEN length(surrogate) <> length(mention) THEN surrogate "
        "ELSE array_join(zip_with(split(mention, ''), split(surrogate, ''), (a, b) -> if(a <> lower(a), upper(b), b)), '') END"
    )
    shaped = F.when(F.col("kind").isin(*_DIGIT_KINDS, "iban"), F.concat(poured, tail)).when((F.col("kind") == "ip") | ((F.col("kind") == "secret") & ~F.col("mention").rlike(_HEX)), F.col("surrogate")).otherwise(cased)
    plain = plain.join(drawn, ["kind", "entity"]).select("mention", shaped.alias("replacement"))
    word = F.when((F.upper("word") == F.col("word")) & (F.length("word") > 1), F.upper("surrogate")).otherwise(F.initcap("surrogate"))
    word = F.concat(word, "suffix")
    head = F.regexp_extract("mention", _HEAD, 0)
    spelled = words.join(drawn.withColumn("kin", _kin("kind")), ["kin", "entity"]).groupBy("name")
    spelled = spelled.agg(F.sort_array(F.collect_list(F.struct("pos", word.alias("w")))).alias("ws"))
    named = named.join(spelled, "name").select("mention", F.concat(head, F.array_join("ws.w", " ")).alias("replacement"))
    return plain.union(named)


def count_name(docs: DataFrame) -> str:
    """The column of the number of mentions replaced: ``n_replaced``, with underscores if the input has one."""
    name, taken = "n_replaced", {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def replace_personal_data(docs: DataFrame, key: str = KEY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with surrogates in its text and ``n_replaced``, the mentions replaced."""
    has = has_mention(text)
    clean = docs.where(~has).withColumn("__pii_n", F.lit(0))
    hit = docs.where(has).withColumn("__pii_hits", mentions_of(text)).withColumn("__pii_text", F.xxhash64(text))
    hit = hit.withColumn("__pii_own", own_names("__pii_hits"))
    again = F.regexp_extract_all(text, F.concat(F.lit("("), _any_or(F.col("__pii_own")), F.lit(")")), F.lit(1))
    hit = stored(hit.withColumn("__pii_hits", F.when(F.col("__pii_own") == "", F.col("__pii_hits")).otherwise(again)), "mentions")
    each = hit.select(F.col(doc_id).alias("__pii_id"), "__pii_text", F.explode(F.array_distinct("__pii_hits")).alias("mention")).distinct()
    table = stored(rendered(each.select("mention").distinct(), key), "rendered")
    maps = each.join(table, "mention").groupBy("__pii_id", "__pii_text")
    maps = maps.agg(F.map_from_entries(F.collect_list(F.struct("mention", "replacement"))).alias("__pii_map"))
    same = hit[doc_id].eqNullSafe(maps["__pii_id"]) & (hit["__pii_text"] == maps["__pii_text"])
    both = hit.join(maps, same).drop(maps["__pii_text"])
    parts = F.expr(
        "array_join(flatten(transform(sequence(0, size(__pii_hits) - 1), "
        "i -> array(__pii_gaps[i], element_at(__pii_map, __pii_hits[i])))), '')"
    )
    new = both.withColumn("__pii_gaps", F.when(F.col("__pii_own") == "", F.split(F.col(text), ANY, -1)).otherwise(F.split(F.col(text), _any_or(F.col("__pii_own")), -1))).withColumn(text, F.concat(parts, F.element_at("__pii_gaps", -1)))
    new = new.withColumn("__pii_n", F.size("__pii_hits"))
    out = [*(F.col(f"`{c}`") for c in docs.columns), F.col("__pii_n").alias(count_name(docs))]
    return clean.select(*out).union(new.select(*out))
