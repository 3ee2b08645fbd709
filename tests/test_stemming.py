"""Stemmers against pairs of the published sample vocabularies."""

import pytest

from sahaf.operators.stemming import stem_tokens, stem_words

# Pairs of the published sample vocabularies.
PAIRS = {
    "en": """consign consign consigned consign consigning consign consignment consign consist consist consisted consist
        consistency consist consistent consist consistently consist consisting consist consists consist consolation consol
        consolations consol consolatory consolatori console consol consoled consol consoles consol consolidate consolid
        consolidated consolid consolidating consolid consoling consol consols consol consonant conson consort consort
        conspicuous conspicu conspicuously conspicu conspiracy conspiraci conspirator conspir conspire conspir constable constabl
        constancy constanc constant constant knack knack knave knave knavish knavish kneaded knead kneading knead knee knee
        kneel kneel kneeled kneel kneeling kneel kneels kneel knees knee knell knell knelt knelt knew knew knick knick
        knitted knit knitting knit knives knive knob knob knock knock knocked knock knot knot knots knot generate generat
        generic generic general general communism communism community communiti skies sky dying die news news ties tie cries cri
        hopping hop hoping hope sky sky by by say say happy happi relational relat rational ration agreed agre feed feed""",
    "de": """aufeinander aufeinand aufenthalt aufenthalt auferlegen auferleg auferlegt auferlegt auferstanden auferstand
        auferstehen aufersteh auferstehung aufersteh auffahren auffahr auffallen auffall auffallend auffall auffassen auffass
        auffassung auffass auffordert auffordert aufforderung aufforder aufgabe aufgab aufgeben aufgeb kategorie kategori
        kategorischen kategor katze katz katzen katz kaufen kauf kaufmann kaufmann kausalität kausalitat kehren kehr kehrte kehrt
        keinen kein keines kein kenntnisse kenntnis freundlichkeit freundlich häuser haus""",
    "es": """cheque chequ chequeo cheque cheques chequ cheves chev chica chic chicano chican chicas chic chico chic
        chicos chic chihuahua chihuahu chihuahuense chihuahuens chilaquiles chilaquil chile chil chilena chilen chiles chil chillar chill
        chimenea chimene china chin chinas chin tortura tortur toro tor torneo torne toronto toront torre torr
        torrencial torrencial torres torr trabajando trabaj trabajadores trabaj torturado tortur comprando compr""",
}


def pairs():
    for lang, text in PAIRS.items():
        words = text.split()
        yield from ((lang, w, s) for w, s in zip(words[::2], words[1::2], strict=True))


def test_published_pairs(spark):
    words = spark.createDataFrame(sorted({(x, w) for x, w, _ in pairs()}), "lang string, word string")
    got = {(r.lang, r.word): r.stem for r in stem_words(words).collect()}
    assert {(x, w): got[x, w] for x, w, _ in pairs()} == {(x, w): s for x, w, s in pairs()}


def test_tokens_keep_their_columns(spark):
    rows = [("en", "Houses", 1, "a"), ("en", "Houses", 1, "a"), (None, "Häuser", 2, "b"), ("xx", "ABC", 3, None), ("en", None, 4, "c"), ("es", "", 5, "d")]
    tokens = spark.createDataFrame(rows, "lang string, word string, _w long, stem string")
    got = stem_tokens(tokens)
    assert got.columns == ["lang", "word", "_w", "stem"]
    want = sorted([("en", 1, "hous"), ("en", 1, "hous"), (None, 2, "häuser"), ("xx", 3, "abc"), ("en", 4, None), ("es", 5, "")], key=str)
    assert sorted([(r.lang, r._w, r.stem) for r in got.collect()], key=str) == want
    assert stem_tokens(tokens.limit(0)).count() == 0


@pytest.mark.parametrize("lang", ["en", "de", "es"])
def test_long_words_pass(spark, lang):
    words = spark.createDataFrame([(lang, "ab" * 20000 + "ing")], "lang string, word string")
    assert stem_words(words).first().stem.startswith("abab")
