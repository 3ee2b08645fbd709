"""Stemmers of ordered steps with regions, for English, German and Spanish, once per distinct word.

Each step takes the longest of its endings that the word has, and drops or replaces it where
it lies in the step's region and what stands before it allows so. Regions (R1, R2, RV) are
counts of the letters before them and are found once, before the first step. The definitions
are the published ones of the Snowball project: Porter2 for English, and German and Spanish
as first published.

A step is one projection of SQL expressions, so a word passes all steps inside one stage.
:func:`stem_words` takes the distinct words; :func:`stem_tokens` joins the stems back to
tokens, columns of any name included.

Words of other languages, or of none, are lower-cased only. A null word has a null stem.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sahaf.session import staged

Projection = dict[str, str]
#: What is known of a word between steps: itself, letters before its regions, and the last ending that was taken.
STATE = {"r1": "0", "r2": "0", "rv": "0", "did": "''", "found": "''"}


@dataclass(frozen=True)
class Rule:
    """What happens to endings: ``before`` must match what precedes them, ``region`` must begin before them."""

    endings: str
    region: str = "0"
    to: str = ""
    before: str = ""


def has(column: str, pattern: str) -> str:
    return f"regexp_extract({column}, '{pattern}', 0) <> ''"


def among(column: str, words: str) -> str:
    return f"{column} IN ({', '.join(repr(x) for x in words.split())})"


def step(*rules: Rule, when: str = "true") -> list[Projection]:
    """The longest ending of all rules is sought, then its rule is tried; ``did`` is the ending if it was taken."""
    endings = [e for r in rules for e in r.endings.split()]
    seek = f"CASE WHEN {when} THEN regexp_extract(w, '^.*?({'|'.join(endings)})$', 1) ELSE '' END"
    base = "substring(w, 1, length(w) - length(found))"
    new, did = "", ""
    for r in rules:
        fits = f"{among('found', r.endings)} AND length(w) - length(found) >= {r.region}"
        if r.before:
            fits += f" AND {has(base, r.before + '$')}"
        new += f" WHEN {fits} THEN concat({base}, '{r.to}')"
        did += f" WHEN {fits} THEN found"
    # A step that is not tried leaves the word and forgets what was taken before it.
    return [{"found": seek}, {"w": f"CASE{new} ELSE w END", "did": f"CASE{did} ELSE '' END"}]


def replaced(*rules: tuple[str, str]) -> Projection:
    w = "w"
    for pattern, to in rules:
        w = f"regexp_replace({w}, '{pattern}', '{to}', 'g')"
    return {"w": w}


def exceptions(pairs: dict[str, str]) -> str:
    return " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in pairs.items())


def regions(vowels: str, r1: str | None = None) -> list[Projection]:
    """R1 begins after the first other letter that follows a vowel, R2 likewise inside R1; none: at the end."""
    head = f"^[^{vowels}]*[{vowels}]+[^{vowels}]"

    def after(text: str) -> str:
        return f"CASE WHEN {has(text, head)} THEN length(regexp_extract({text}, '{head}', 0)) ELSE length({text}) END"

    return [{"r1": r1 or after("w")}, {"r2": f"r1 + {after('substring(w, r1 + 1, length(w))')}"}]


# --- English -----------------------------------------------------------------

# Words with stems of their own, and words that the later steps leave alone.
EN_OWN = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl",
    "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl", "sky": "sky", "news": "news", "howe": "howe",
    "atlas": "atlas", "cosmos": "cosmos", "bias": "bias", "andes": "andes",
}
EN_LEFT = "inning outing canning herring earring proceed exceed succeed"
EN_SHORT = "([^aeiouy][aeiouy][^aeiouywxY]|^[aeiouy][^aeiouy])$"
_EN_HEAD = "^[^aeiouy]*[aeiouy]+[^aeiouy]"
_EN_STARTS = "^(gener|commun|arsen)"


def english() -> list[Projection]:
    r1 = (
        f"CASE WHEN {has('w', _EN_STARTS)} THEN length(regexp_extract(w, '{_EN_STARTS}', 0))"
        f" WHEN {has('w', _EN_HEAD)} THEN length(regexp_extract(w, '{_EN_HEAD}', 0)) ELSE length(w) END"
    )
    open_ = f"NOT {among('w', EN_LEFT)}"
    doubled = "(bb|dd|ff|gg|mm|nn|pp|rr|tt)$"
    mended = f"""CASE WHEN NOT {among("did", "ed edly ing ingly")} THEN w WHEN {has("w", "(at|bl|iz)$")} THEN concat(w, 'e')
      WHEN {has("w", doubled)} THEN substring(w, 1, length(w) - 1)
      WHEN {has("w", EN_SHORT)} AND r1 >= length(w) THEN concat(w, 'e') ELSE w END"""
    return [
        replaced(("^y", "Y"), ("([aeiouy])y", "$1Y")),
        *regions("aeiouy", r1),
        *step(Rule("sses", to="ss"), Rule("ied ies", to="i", before="..")),
        *step(Rule("ied ies", to="ie"), when="did = ''"),
        *step(Rule("us ss", region="1000000"), Rule("s", before="[aeiouy].+"), when="did = ''"),
        *step(Rule("eed eedly", "r1", "ee"), Rule("ed edly ing ingly", before="[aeiouy].*"), when=open_),
        {"w": mended},
        *step(Rule("y Y", to="i", before=".[^aeiouy]"), when=open_),
        *step(
            Rule("tional", "r1", "tion"), Rule("enci", "r1", "ence"), Rule("anci", "r1", "ance"), Rule("abli", "r1", "able"),
            Rule("entli", "r1", "ent"), Rule("izer ization", "r1", "ize"), Rule("ational ation ator", "r1", "ate"),
            Rule("alism aliti alli", "r1", "al"), Rule("fulness fulli", "r1", "ful"), Rule("ousli ousness", "r1", "ous"),
            Rule("iveness iviti", "r1", "ive"), Rule("biliti bli", "r1", "ble"), Rule("ogi", "r1", "og", "l"),
            Rule("lessli", "r1", "less"), Rule("li", "r1", "", "[cdeghkmnrt]"), when=open_,
        ),
        *step(
            Rule("tional", "r1", "tion"), Rule("ational", "r1", "ate"), Rule("alize", "r1", "al"),
            Rule("icate iciti ical", "r1", "ic"), Rule("ful ness", "r1"), Rule("ative", "r2"), when=open_,
        ),
        *step(
            Rule("al ance ence er ic able ible ant ement ment ent ism ate iti ous ive ize", "r2"), Rule("ion", "r2", "", "[st]"),
            when=open_,
        ),
        *step(Rule("e", "r2"), Rule("l", "r2", "", "l"), when=open_),
        {"w": f"""CASE WHEN did = '' AND {open_} AND {has("w", "e$")} AND length(w) - 1 >= r1
          AND NOT {has("substring(w, 1, length(w) - 1)", EN_SHORT)} THEN substring(w, 1, length(w) - 1) ELSE w END"""},
        replaced(("Y", "y")),
        {"w": f"CASE WHEN length(word) <= 2 THEN lower(word) ELSE CASE lower(word) {exceptions(EN_OWN)} ELSE w END END"},
    ]


# --- German ------------------------------------------------------------------


def german() -> list[Projection]:
    v = "aeiouyäöü"
    return [
        replaced(("ß", "ss"), (f"([{v}])u([{v}])", "$1U$2"), (f"([{v}])y([{v}])", "$1Y$2")),
        *regions(v),
        {"r1": "CASE WHEN r1 < 3 THEN least(3, length(w)) ELSE r1 END"},
        *step(Rule("em ern er e en es", "r1"), Rule("s", "r1", "", "[bdfghklmnrt]")),
        {"w": f"CASE WHEN {among('did', 'e en es')} AND {has('w', 'niss$')} THEN substring(w, 1, length(w) - 1) ELSE w END"},
        *step(Rule("en er est", "r1"), Rule("st", "r1", "", "...[bdfghklmnt]")),
        *step(Rule("end ung", "r2"), Rule("ig ik isch", "r2", "", "[^e]"), Rule("lich heit keit", "r2")),
        {"rv": f"CASE WHEN {among('did', 'end ung')} THEN 1 WHEN {among('did', 'lich heit')} THEN 2 WHEN did = 'keit' THEN 3 ELSE 0 END"},
        *step(Rule("ig", "r2", "", "[^e]"), when="rv = 1"),
        *step(Rule("er en", "r1"), when="rv = 2"),
        *step(Rule("lich ig", "r2"), when="rv = 3"),
        replaced(("U", "u"), ("Y", "y"), ("ä", "a"), ("ö", "o"), ("ü", "u")),
    ]


# --- Spanish -----------------------------------------------------------------

ES_VERBS = """arían arías arán arás aríais aría aréis aríamos aremos ará aré erían erías erán erás eríais ería eréis eríamos
    eremos erá eré irían irías irán irás iríais iría iréis iríamos iremos irá iré aba ada ida ía ara iera ad ed id ase iese
    aste iste an aban ían aran ieran asen iesen aron ieron ado ido ando iendo ió ar er ir as abas adas idas ías aras ieras
    ases ieses ís áis abais íais arais ierais aseis ieseis asteis isteis ados idos amos ábamos íamos imos áramos iéramos
    iésemos ásemos"""
ES_VOWELS = "aeiouáéíóúü"


def spanish() -> list[Projection]:
    v = ES_VOWELS
    heads = [f"^.[^{v}][^{v}]*[{v}]", f"^[{v}][{v}]+[^{v}]", f"^[^{v}][{v}]."]
    rv = " ".join(f"WHEN {has('w', h)} THEN length(regexp_extract(w, '{h}', 0))" for h in heads)
    pronouns = "me se sela selo selas selos la le lo las les los nos"
    bare = "substring(w, 1, length(w) - length(found))"
    gerund = "(iéndo|ándo|ár|ér|ír|ando|iendo|ar|er|ir|yendo)$"
    verb = f"regexp_extract({bare}, '{gerund}', 1)"
    plain = f"concat(substring({bare}, 1, length({bare}) - length({verb})), translate({verb}, 'áéí', 'aei'))"
    return [
        *regions(v),
        {"rv": f"CASE {rv} ELSE length(w) END"},
        {"found": f"regexp_extract(w, '^.*?({'|'.join(pronouns.split())})$', 1)"},
        {"w": f"""CASE WHEN found <> '' AND {verb} <> '' AND length({bare}) - length({verb}) >= rv
          AND ({verb} <> 'yendo' OR {has(bare, "uyendo$")}) THEN {plain} ELSE w END"""},
        *step(
            Rule("""anza anzas ico ica icos icas ismo ismos able ables ible ibles ista istas oso osa osos osas amiento amientos
                imiento imientos""", "r2"),
            Rule("adora ador ación adoras adores aciones ante antes ancia ancias", "r2"),
            Rule("logía logías", "r2", "log"), Rule("ución uciones", "r2", "u"), Rule("encia encias", "r2", "ente"),
            Rule("amente", "r1"), Rule("mente idad idades iva ivo ivas ivos", "r2"),
        ),
        # What was taken stays known, as the number of its kind, until the verbs' endings are tried.
        {"found": f"""CASE WHEN did = '' THEN '' WHEN did = 'amente' THEN 'a' WHEN did = 'mente' THEN 'm' WHEN {among("did", "idad idades")}
          THEN 'i' WHEN {among("did", "iva ivo ivas ivos")} THEN 'v' WHEN {among("did",
          "adora ador ación adoras adores aciones ante antes ancia ancias")} THEN 'c' ELSE 'o' END"""},
        {"did": "found"},
        {"w": f"""CASE WHEN did = 'c' AND {inside("ic", "r2")} THEN {cut(2)} WHEN did = 'a' AND {inside("ativ", "r2")} THEN {cut(4)}
          WHEN did = 'a' AND ({inside("iv", "r2")} OR {inside("os", "r2")} OR {inside("ic", "r2")} OR {inside("ad", "r2")}) THEN {cut(2)}
          WHEN did = 'm' AND ({inside("ante", "r2")} OR {inside("able", "r2")} OR {inside("ible", "r2")}) THEN {cut(4)}
          WHEN did = 'i' AND {inside("abil", "r2")} THEN {cut(4)}
          WHEN did = 'i' AND ({inside("ic", "r2")} OR {inside("iv", "r2")}) THEN {cut(2)}
          WHEN did = 'v' AND {inside("at", "r2")} THEN {cut(2)} ELSE w END"""},
        *kept_flag(step(Rule("ya ye yan yen yeron yendo yo yó yas yes yais yamos", "rv", "", "u"), when="did = ''")),
        *kept_flag(within("rv", [("en es éis emos", True), (ES_VERBS, False)], "did = ''")),
        *within("rv", [("os a o á í ó", False), ("e é", True)], "true"),
        replaced(("á", "a"), ("é", "e"), ("í", "i"), ("ó", "o"), ("ú", "u")),
    ]


def inside(ending: str, region: str) -> str:
    return f"({has('w', ending + '$')} AND length(w) - {len(ending)} >= {region})"


def cut(n: int) -> str:
    return f"substring(w, 1, length(w) - {n})"


def kept_flag(steps: list[Projection]) -> list[Projection]:
    """The step, but ``did`` stays what it was where nothing was taken."""
    seek, take = steps
    return [seek, {**take, "did": take["did"].replace("ELSE ''", "ELSE did")}]


def within(region: str, kinds: list[tuple[str, bool]], when: str) -> list[Projection]:
    """The longest ending inside the region is dropped, and a u after g with it where so stated."""
    endings = "|".join(e for es, _ in kinds for e in es.split())
    seek = f"CASE WHEN {when} THEN regexp_extract(substring(w, {region} + 1, length(w)), '^.*?({endings})$', 1) ELSE '' END"
    base = "substring(w, 1, length(w) - length(found))"
    gu = " ".join(f"WHEN {among('found', es)} AND {has(base, 'gu$')} AND ({when} AND length({base}) - 1 >= {floor})"
                  f" THEN substring({base}, 1, length({base}) - 1)"
                  for es, also in kinds if also for floor in [region if len(es.split()) == 2 else "0"])
    return [{"found": seek}, {"w": f"CASE {gu} ELSE {base} END", "did": "CASE WHEN found <> '' THEN found ELSE '' END"}]


STEMMERS = {"en": english(), "de": german(), "es": spanish()}


def chained(words: DataFrame, steps: list[Projection], kept: tuple[str, ...]) -> DataFrame:
    columns = [*kept, "w", *STATE]
    out = words.selectExpr("lang", "word", *kept, "lower(word) AS w", *[f"{v} AS {k}" for k, v in STATE.items()])
    for changes in steps:
        new = {k: v.replace(", 'g')", ")") for k, v in changes.items()}
        out = out.selectExpr("lang", "word", *[f"{new[c]} AS {c}" if c in new else c for c in columns])
    return out.selectExpr("lang", "word", "w AS stem", *kept)


def chained_sql(source: str, lang: str) -> str:
    """The same steps as SQL of another engine over ``source`` (lang, word)."""
    columns = ["w", *STATE]
    out = f"SELECT lang, word, lower(word) AS w, {', '.join(f'{v} AS {k}' for k, v in STATE.items())} FROM {source} WHERE lang = '{lang}'"
    for changes in STEMMERS[lang]:
        new = {k: v.replace("'$1U$2'", r"'\1U\2'").replace("'$1Y$2'", r"'\1Y\2'").replace("'$1Y'", r"'\1Y'") for k, v in changes.items()}
        out = f"SELECT lang, word, {', '.join(f'{new[c]} AS {c}' if c in new else c for c in columns)} FROM ({out})"
    return f"SELECT lang, word, w AS stem FROM ({out})"


def stem_words(words: DataFrame, *kept: str) -> DataFrame:
    """(lang, word, stem, kept..) of words (lang, word, ..); give each pair once.

    Columns to keep have names other than those of the steps (w, r1, r2, rv, did, found).
    """
    known = F.coalesce(F.col("lang").isin(*STEMMERS), F.lit(False))
    # Read once for every language: written first, so that what made the words runs once.
    words = staged(words.select("lang", "word", *kept), "stem-words")
    out = words.where(~known).select("lang", "word", F.lower("word").alias("stem"), *kept)
    for lang, steps in STEMMERS.items():
        out = out.union(chained(words.where(F.col("lang") == lang), steps, kept))
    return out


def stem_tokens(tokens: DataFrame) -> DataFrame:
    """Adds ``stem`` to tokens (lang, word, ..): each distinct word is stemmed once and joined back."""
    words = stem_words(tokens.select("lang", "word").distinct()).select(
        F.col("lang").alias("_l"), F.col("word").alias("_w"), F.col("stem").alias("_s")
    )
    row = F.struct(*[F.col(f"`{c}`") for c in tokens.columns if c != "stem"]).alias("row")
    joined = tokens.select(row).join(words, F.col("row.lang").eqNullSafe(F.col("_l")) & F.col("row.word").eqNullSafe(F.col("_w")))
    return joined.select("row.*", F.col("_s").alias("stem"))
