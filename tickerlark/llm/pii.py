"""Personal data: keyed, type-consistent surrogates, by DataFrame functions only."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerlark.llm.scratch import dropped, free, stored

TITLES_M = ("Mr.", "Mr", "Herr", "Señor", "Monsieur", "г-н", "κ.")
TITLES_F = ("Mrs.", "Mrs", "Ms.", "Ms", "Miss", "Frau", "Señora", "Señorita", "Madame", "г-жа", "κα")
#: Titles of either gender: the surrogate's given name has no ending.
TITLES_X = ("Dr.", "Dr", "Prof.", "Prof", "Rev.", "д-р")
TITLES = tuple(sorted(TITLES_M + TITLES_F + TITLES_X, key=len, reverse=True))
#: What credentials stand after, in any case; their own characters, a dot between two of them too.
WORD = r"(?i:password|passwd|passphrase|pwd|token|secret|api[_-]?key|access[_-]?key)"
CREDENTIAL = r"(?:[A-Za-z0-9_+/~=-]|[.](?=[A-Za-z0-9])){8,}+"
HEX4 = r"[0-9A-Fa-f]{1,4}"
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
#: What is detected, in the order in which a place is tried. Look-behinds keep the search linear.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@(?:[\p{L}\p{N}-]+\.)+\p{L}{2,24}(?![\p{L}\p{N}])",
    # the shorter look-behind rules out nearly all places before the longer one is tried
    "secret": r"(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9])|(?<=[=: \"'])(?<=[=:][ ]{0,2}[\"']?)(?<=\b"
    + WORD + r"[ ]{0,2}[=:][ ]{0,2}[\"']?)(?<![A-Za-z0-9])" + CREDENTIAL,
    "ip": rf"(?<![\p{{L}}\p{{N}}.]){OCTET}(?:\.{OCTET}){{3}}(?!\.?\d)(?![\p{{L}}_])",
    "ip6": rf"(?<![\p{{L}}\p{{N}}:.])(?=[A-Fa-f:]*+[0-9])(?:{HEX4}(?::{HEX4}){{7}}|[0-9A-Fa-f]{{3,4}}(?::{HEX4}){{0,6}}::(?:{HEX4}(?::{HEX4}){{0,6}})?)(?![\p{{L}}\p{{N}}:])",
    "ssn": r"(?<![\p{L}\p{N}-])\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}-])",
    "card": r"(?<![\p{L}\p{N}+.-])\d(?:[ -]?\d){12,18}(?![\p{L}\p{N}])",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "phone": r"(?<![\p{L}\p{N}+(])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{3}[.-])\d{3}[ .-]\d{3,4}(?![\p{L}\p{N}-])|(?<![\p{L}\p{N}+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?![\p{L}\p{N}])|(?<![\p{L}\p{N}+.,-])(?<!\d )\d{3} \d{3} \d{4}(?![\p{L}\p{N}-])(?! \d)",
    "name": rf"(?<![\p{{L}}\p{{N}}])(?:{'|'.join(map(re.escape, TITLES))})(?: \p{{Lu}}[\p{{L}}'-]{{1,30}}){{1,3}}(?![\p{{L}}])",
}
#: What ends a run of numbers before its next group: an email, an address or a number with dots.
OTHER = rf"[\p{{L}}\p{{N}}._%+-]++@|{OCTET}(?:\.{OCTET}){{3}}(?!\.?\d)|(?:\d{{3}}\.\d{{3}}[ .-]|\d{{3}}-\d{{3}}\.)\d{{3,4}}(?![\p{{L}}\p{{N}}-])"
#: Groups of digits in a row, 13 digits or more: it may hold several entities, which are looked for inside.
RUN = rf"(?<![\p{{L}}\p{{N}}+.-])(?=\d(?:[ -]?\d){{12}})\d++(?![\p{{L}}\p{{N}}])(?:[ -](?!{OTHER})\d++(?![\p{{L}}\p{{N}}]))*+"
ANY = "|".join(RUN if kind == "card" else pattern for kind, pattern in PATTERNS.items())
#: Inside a run, at every group: usual layouts of cards, phones, social security numbers; then 13 to 19 digits in any groups.
CARDS = (r"\d{4}(?:[ -]\d{4}){3}[ -]\d{1,3}(?!\d)", r"\d{4}(?:[ -]\d{4}){3}(?!\d)", r"\d{13,19}(?!\d)", r"\d{4}[ -]\d{6}[ -]\d{4,5}(?!\d)")
PHONE = r"\d{3}-\d{3}[ -]\d{3,4}(?![\d-])"
SSN = r"(?<!-)\d{3}-\d{2}-\d{4}(?![\d-])"
LOOSE = tuple(rf"(?:\d[ -]?){{{n - 1}}}\d(?!\d)" for n in range(19, 12, -1))
KEYWORD = WORD + r"[ ]{0,2}[=:]"
#: A text without any of these holds nothing of PATTERNS.
HINT = r"[@0-9]|::|" + KEYWORD + "|" + "|".join(re.escape(t) + " " for t in TITLES)
#: Syllables of surrogate names and their endings by script and gender.
SYLLABLES = {
    "latin": ("ba be bi bo da de di do fa fe ga go ha jo ka ke la le li lo ma me mi mo na ne ni no pa po ra re ri ro sa se si so ta te ti to va ve vi wa".split(), {"m": "n", "f": "a", "s": "rd", "x": ""}),
    "cyrillic": ("ба ве ви го да де ди за ка ке ла ле ли ло ма ме ми мо на не ни но па по ра ре ри ро са се си та те ти то".split(), {"m": "н", "f": "на", "s": "ко", "x": ""}),
    "greek": ("βα γε δα δη θε κα κη λα λε μα με μι να νε νι πα πε ρα ρε ρι σα σε τα τε τι φα χα".split(), {"m": "ος", "f": "α", "s": "ου", "x": ""}),
}


@dataclass(frozen=True)
class Pii:
    key: str = "replace this key"
    rounds: int = 64  # new tries for surrogates that collide, before one gets a suffix


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, r"[^0-9]", "")


def _luhn_sum(digits: Column, doubled: int) -> Column:
    """The Luhn sum; every second digit from the right counts double, from place ``doubled`` on."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == doubled, c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)).otherwise(c.cast("int")))
    return F.aggregate(each, F.lit(0), lambda s, x: s + x)


def _kind(mention: Column) -> Column:
    out = F.lit(None).cast("string")
    # a credential is known by what stands before it, which is not seen here: it is what is left
    for kind, pattern in sorted(reversed(PATTERNS.items()), key=lambda x: x[0] != "secret"):
        whole = f"^(?:{pattern})$"
        if kind == "secret":
            hit = mention.rlike(f"^{CREDENTIAL}$") & ~mention.rlike(f"^(?:{PATTERNS['card']})$")
        elif kind == "card":
            hit = mention.rlike(whole) & (_luhn_sum(_digits(mention), 1) % 10 == 0)
        else:
            hit = mention.rlike(whole)
        out = F.when(hit, F.lit(kind)).otherwise(out)
    return out


def _is_run(mention: Column) -> Column:
    return mention.rlike(r"^\d[\d -]*+$")


def _run_units(run: Column) -> Column:
    """A run of numbers as parts (kind, norm, raw); what is no entity has kind ''.

    Candidates start at every group, so none hides another: those in a usual layout are taken
    first, then the longest of other groupings in what is left. Cards must pass Luhn.
    """
    at = lambda layout: F.regexp_extract_all(run, F.lit(rf"(?<!\d)(?=({layout}))"), F.lit(1))
    valid = lambda layouts: F.filter(F.concat(*map(at, layouts)), lambda x: _luhn_sum(_digits(x), 1) % 10 == 0)
    one_of = lambda x: F.when(F.size(x) == 0, "(?!)").otherwise(F.concat(F.lit("(?<![0-9])(?:"), F.array_join(F.array_distinct(x), "|"), F.lit(")(?![0-9])")))
    part = lambda kind, x: F.struct(kind.alias("kind"), F.when(kind == "", x).otherwise(_digits(x)).alias("norm"), x.alias("raw"))
    usual, loose = one_of(F.concat(valid(CARDS), at(PHONE), at(SSN))), one_of(valid(LOOSE))
    kind = lambda x: F.when(x.rlike(f"^{PHONE}$"), "phone").when(x.rlike(f"^{SSN}$"), "ssn").otherwise("card")

    def cut(x: Column, pattern: Column, gap) -> Column:
        parts = F.zip_with(F.split(x, pattern, -1), F.regexp_extract_all(x, pattern, F.lit(0)), lambda g, m: F.concat(gap(g), F.array(part(kind(m), m))))
        return F.filter(F.flatten(parts), lambda u: u["raw"].isNotNull() & (u["raw"] != ""))

    return cut(run, usual, lambda g: cut(g, loose, lambda h: F.array(part(F.lit(""), h))))


def _script(word: Column) -> Column:
    return F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic").when(word.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _units(mention: Column, kind: Column) -> Column:
    """A mention as parts (kind, norm, raw): the entity itself; for names the title and each word."""
    words = F.split(mention, " ")
    gender = F.when(words[0].isin(*TITLES_M), "m").when(words[0].isin(*TITLES_F), "f").otherwise("x")
    last = F.size(words) - 1
    named = F.transform(
        words,
        lambda w, i: F.struct(
            F.when(i == 0, F.lit("")).when(i == last, F.concat(F.lit("surname:"), _script(w))).otherwise(F.concat(F.lit("given-"), gender, F.lit(":"), _script(w))).alias("kind"),
            F.lower(w).alias("norm"),
            w.alias("raw"),
        ),
    )
    norm = F.when(kind.isin("card", "phone", "ssn"), _digits(mention)).when(kind.isin("email", "ip6"), F.lower(mention)).when(kind == "iban", F.regexp_replace(mention, " ", "")).otherwise(mention)
    return F.when(kind == "name", named).otherwise(F.array(F.struct(kind.alias("kind"), norm.alias("norm"), mention.alias("raw"))))


def _bits(p: Pii, i: Column, most: int) -> Column:
    """The i-th number below ``most`` of the keyed stream of an entity and its try."""
    seed = F.concat_ws("\x1f", F.lit(p.key), "kind", "norm", F.col("attempt").cast("string"), F.floor(i / 16).cast("string"))
    part = F.substring(F.sha2(seed, 256), (4 * F.pmod(i, F.lit(16)) + 1).cast("int"), F.lit(4))
    return F.pmod(F.conv(part, 16, 10).cast("int"), F.lit(most))


def _like(p: Pii, text: Column, keep: Column) -> Column:
    """Each letter and digit for another of its class; the last ``keep`` characters, and marks, stay."""

    def one(c: Column, i: Column) -> Column:
        n = _bits(p, i, 65536)
        pick = lambda letters: F.substring(F.lit(letters), (n % len(letters) + 1).cast("int"), F.lit(1))
        hexed = (F.col("norm").rlike("^[0-9a-f]+$") & (F.col("kind") == "secret")) | ((F.col("kind") == "ip6") & (c != ":"))
        new = F.when(hexed, pick("0123456789abcdef")).when(c.rlike("[0-9]"), pick("0123456789")).when(c.rlike("[A-Z]"), pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ")).when(c.rlike("[a-z]"), pick("abcdefghijklmnopqrstuvwxyz")).when(c.rlike(r"\p{IsCyrillic}"), pick("абвгдежзиклмнопрст")).when(c.rlike(r"\p{L}"), pick("abcdefghijklmnopqrstuvwxyz")).otherwise(c)
        return F.when(i >= F.length(text) - keep, c).otherwise(new)

    return F.array_join(F.transform(F.split(text, ""), one), "")


def _surrogate(p: Pii) -> Column:
    """For rows (kind, norm, attempt): a replacement of the same type, script and format."""
    norm, kind = F.col("norm"), F.col("kind")
    octets = F.transform(
        F.split(norm, r"\."),
        lambda o, i: F.when(F.length(o) == 3, 100 + _bits(p, i, 156)).when(F.length(o) == 2, 10 + _bits(p, i, 90)).otherwise(_bits(p, i, 10)).cast("string"),
    )
    body = _like(p, norm, F.lit(1))
    card = F.concat(F.substring(norm, 1, 1), F.substring(body, F.lit(2), F.length(norm) - 2))
    card = F.concat(card, F.pmod(10 - _luhn_sum(card, 0) % 10, F.lit(10)).cast("string"))
    code = F.greatest(F.length(norm) - 7, F.lit(0))  # what stands before the last seven digits stays
    phone = F.concat(F.substring(norm, F.lit(1), code), F.substring(_like(p, norm, F.lit(0)), code + 1, F.length(norm)))
    tail = F.length(F.substring_index(norm, ".", -1)) + 1
    out = F.when(kind == "ip", F.array_join(octets, ".")).when(kind == "card", card).when(kind == "phone", phone)
    out = out.when(kind == "iban", F.concat(F.substring(norm, 1, 2), F.substring(_like(p, norm, F.lit(0)), F.lit(3), F.length(norm))))
    out = out.when(kind == "email", _like(p, norm, tail)).when(kind.isin("ssn", "secret", "ip6"), F.when(norm.startswith("AKIA"), F.concat(F.lit("AKIA"), F.substring(_like(p, norm, F.lit(0)), F.lit(5), F.length(norm)))).otherwise(_like(p, norm, F.lit(0))))
    for script, (syllables, ends) in SYLLABLES.items():
        parts = F.array(*map(F.lit, syllables))
        name = F.array_join(F.transform(F.sequence(F.lit(0), 2 + F.floor(F.col("attempt") / 8).cast("int")), lambda i: F.element_at(parts, _bits(p, i, len(syllables)) + 1)), "")  # noqa: B023
        for role, end in (("given-m", ends["m"]), ("given-f", ends["f"]), ("given-x", ends["x"]), ("surname", ends["s"])):
            out = out.when(kind == f"{role}:{script}", F.concat(name, F.lit(end)))
    return out


def surrogates(entities: DataFrame, p: Pii | None = None) -> DataFrame:
    """(kind, norm, surrogate) for the distinct rows of ``entities(kind, norm)``.

    The same key gives the same surrogate for an entity in every run over the same entities. No
    two entities of a kind share a surrogate, and none is itself an entity of its kind: of those
    that collide the first keeps its try, the others draw again. After ``rounds`` tries (a format
    with fewer forms than entities) a suffix from the entity's keyed digest makes it distinct.
    """
    p = p or Pii()
    now = stored(entities.distinct().withColumn("attempt", F.lit(0)).withColumn("surrogate", _surrogate(p)), "surrogates")
    for attempt in range(1, p.rounds + 1):
        first = now.groupBy("kind", "surrogate").agg(F.min(F.struct("attempt", "norm")).alias("first"), F.count("*").alias("n")).where("n > 1")
        twice = now.join(first, ["kind", "surrogate"]).where(F.struct("attempt", "norm") != F.col("first")).select("kind", "norm")
        real = now.join(now.select("kind", F.col("norm").alias("surrogate")), ["kind", "surrogate"], "left_semi").select("kind", "norm")
        again = stored(twice.unionAll(real).distinct(), "collisions")
        if again.isEmpty():
            dropped(again)
            break
        redo = now.join(again, ["kind", "norm"], "left_semi").withColumn("attempt", F.lit(attempt))
        if attempt == p.rounds:
            redo = redo.withColumn("surrogate", F.concat("surrogate", F.lit("-"), F.sha2(F.concat_ws("\x1f", F.lit(p.key), "norm"), 256)))
        else:
            redo = redo.withColumn("surrogate", _surrogate(p))
        nxt = stored(now.join(again, ["kind", "norm"], "left_anti").unionAll(redo), "surrogates")
        dropped(now, again)
        now = nxt
    return now.select("kind", "norm", "surrogate")


def _rendered(kind: Column, raw: Column, new: Column) -> Column:
    """The surrogate in the format of one mention: its marks, its spaces, its capitals."""
    chars = F.split(raw, "")
    start = F.struct(F.lit("").alias("out"), new.alias("left"))

    def step(s: Column, c: Column) -> Column:
        takes = F.when(kind.isin("card", "phone", "ssn"), c.rlike("[0-9]")).otherwise(c != " ")
        letter = F.substring(s["left"], 1, 1)
        letter = F.when((F.lower(c) != c) & (kind == "email"), F.upper(letter)).otherwise(letter)
        return F.struct(F.concat(s["out"], F.when(takes, letter).otherwise(c)).alias("out"), F.when(takes, F.substring(s["left"], F.lit(2), F.length(s["left"]))).otherwise(s["left"]).alias("left"))

    fold = F.aggregate(chars, start, step)
    cased = F.when(raw == F.upper(raw), F.upper(new)).otherwise(F.initcap(new))
    return F.when(kind.rlike("^(given|surname)"), cased).when(F.length(new) > F.length(raw), new).otherwise(F.concat(fold["out"], F.when(fold["left"] != "", fold["left"]).otherwise("")))


def replace_pii(docs: DataFrame, p: Pii | None = None) -> DataFrame:
    """``docs`` with ``text`` rewritten and ``n_entities`` (mentions replaced) added.

    Detected: email, credential (of any length, after a keyword in any case), IPv4, IPv6, social
    security number, card (Luhn), IBAN, phone, names after a title, and their surnames where they
    stand alone in the same text. Ten digits without marks are not taken for a phone. Kept are an email's last label, what stands before a phone's
    last seven digits, an IBAN's country. Numbers in a row are searched at every group, so a neighbour hides none; what
    stands after a keyword of credentials is one, whatever it looks like. An entity gets the same surrogate everywhere (numbers by their digits, emails
    and names without regard to case, names word by word, so a surname alone keeps its
    surrogate); gender follows the title. Texts without a mention, and null, pass unchanged with
    0. A column n_entities of ``docs`` is replaced; all other columns and all rows stay, repeated and null ids too: rows are matched by a
    digest of their text, not by id.

    Mentions are stored narrow; an entity in very many texts is one row of a shuffled join, which
    adaptive execution can split; only texts with a mention are joined with their replacements.
    """
    p = p or Pii()
    docs = docs.drop("n_entities")
    hit_name, key_name, new_name, word_name = (free(docs, x) for x in ("__hit", "__key", "__new", "__words"))
    added = docs.withColumn(hit_name, F.coalesce(F.col("text").rlike(HINT) & F.col("text").rlike(ANY), F.lit(False)))
    hit = added.where(F.col(hit_name)).drop(hit_name).withColumn(key_name, F.md5("text"))
    secrets = F.when(F.col("text").rlike(KEYWORD), F.regexp_extract_all("text", F.lit(PATTERNS["secret"]), F.lit(0)))
    seen = hit.select(F.col(key_name).alias("__key"), secrets.alias("secrets"), F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(ANY), F.lit(0)))).alias("mention"))
    seen = seen.select("__key", "mention", F.coalesce(F.array_contains("secrets", F.col("mention")), F.lit(False)).alias("secret")).distinct()
    mention = F.col("mention")
    kind = F.when(~F.col("secret") & _is_run(mention) & ~mention.rlike(r"^\d{3} \d{3} \d{4}$"), "run").otherwise(F.coalesce(_kind(mention), F.when(F.col("secret"), "secret")))
    seen = seen.select("__key", "mention", kind.alias("whole")).where("whole is not null")
    parts = F.when(F.col("whole") == "run", _run_units(mention)).otherwise(_units(mention, F.col("whole")))
    seen = seen.withColumn("parts", parts).where(F.exists("parts", lambda x: x["kind"] != ""))
    units = stored(seen.select("__key", "mention", "whole", F.posexplode("parts")).select("__key", "mention", "whole", "pos", "col.*"), "mentions")
    made = surrogates(units.where("kind <> ''").select("kind", "norm"), p)
    at = ("__key", "mention", "whole", "pos", "kind")
    rendered = units.where("kind <> ''").join(made, ["kind", "norm"]).select(*at, _rendered(F.col("kind"), F.col("raw"), F.col("surrogate")).alias("new"))
    rendered = rendered.unionAll(units.where("kind = ''").select(*at, F.col("raw").alias("new")))
    news = F.transform(F.sort_array(F.collect_list(F.struct("pos", "new"))), lambda x: x["new"])
    n = F.when(F.col("whole") == "run", F.count(F.when(F.col("kind") != "", 1))).otherwise(1)
    mention = rendered.groupBy("__key", "mention", "whole").agg(F.when(F.col("whole") == "name", F.array_join(news, " ")).otherwise(F.array_join(news, "")).alias("new"), n.alias("n"))
    news = F.map_from_entries(F.collect_list(F.struct("mention", F.struct("new", "n")))).alias(new_name)
    maps = mention.groupBy("__key").agg(news).withColumnRenamed("__key", key_name)
    words = rendered.where("whole = 'name' and kind like 'surname%'").join(units.select("__key", "mention", "pos", "raw"), ["__key", "mention", "pos"]).where(F.length("raw") > 2)
    words = words.groupBy("__key").agg(F.array_distinct(F.sort_array(F.collect_list(F.struct("raw", "new")))).alias(word_name)).withColumnRenamed("__key", key_name)
    found, gaps = F.regexp_extract_all("text", F.lit(ANY), F.lit(0)), F.split("text", ANY, -1)
    alone = lambda g: F.aggregate(F.coalesce(F.col(word_name), F.array()), g, lambda t, w: F.regexp_replace(t, F.concat(F.lit(r"(?<![\p{L}\p{N}])\Q"), w["raw"], F.lit(r"\E(?![\p{L}\p{N}])")), w["new"]))
    text = F.array_join(F.zip_with(gaps, F.transform(found, lambda m: F.coalesce(F.col(new_name)[m]["new"], m)), lambda g, m: F.concat(alone(g), F.coalesce(m, F.lit("")))), "")
    joined = hit.join(maps, key_name, "left").join(words, key_name, "left")
    n = F.aggregate(found, F.lit(0).cast("long"), lambda s, m: s + F.coalesce(F.col(new_name)[m]["n"], F.lit(0)))
    changed = joined.select(*[F.when(F.col(new_name).isNotNull(), text).otherwise(F.col("text")).alias("text") if c == "text" else F.col(c) for c in docs.columns], F.when(F.col(new_name).isNotNull(), n).otherwise(F.lit(0).cast("long")).alias("n_entities"))
    rest = added.where(~F.col(hit_name)).select(*docs.columns, F.lit(0).cast("long").alias("n_entities"))
    return rest.unionAll(changed)
