import re

import pytest
from pyspark.sql import functions as F

from glotta.functions import text as T
from glotta.functions.rules import COMMANDS, COMMANDS_V1, GENERAL_ABBREVIATIONS, MEDICAL_ABBREVIATIONS


def apply(spark, f, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, t string")
    return [r.x for r in df.select("i", f(F.col("t")).alias("x")).orderBy("i").collect()]


#: An abbreviation each, and the text it must become.
ABBREVIATED = [
    ("etc. 1", "et cetera. 1"),
    ("cf. 1", "confer. 1"),
    ("vs. 1", "versus. 1"),
    ("ex. 1", "exemple. 1"),
    ("n° 1", "numéro 1"),
    ("p. ex. 1", "par exempleemple. 1"),
    ("c.à.d. 1", "c'est à dire 1"),
    ("Dr 1", "docteur 1"),
    ("Drs 1", "docteurs 1"),
    ("Pr 1", "professeur 1"),
    ("Mme 1", "madame 1"),
    ("Mmes 1", "mesdames 1"),
    ("M 1", "monsieur 1"),
    ("MM 1", "messieurs 1"),
    ("bpm 1", "battements par minute 1"),
    ("mg/kg 1", "milligrammes par kilogramme 1"),
    ("mg/L 1", "milligrammes par litre 1"),
    ("mg 1", "milligrammes 1"),
    ("ml 1", "millilitres 1"),
    ("cL 1", "centilitres 1"),
    ("L 1", "litres 1"),
    ("cm 1", "centimètres 1"),
    ("mm 1", "millimètres 1"),
    ("μm 1", "micromètres 1"),
    ("nm 1", "nanomètres 1"),
    ("kg 1", "kilogrammes 1"),
    ("g 1", "grammes 1"),
    ("μg 1", "microgrammes 1"),
    ("ng 1", "nanogrammes 1"),
    ("mmHg 1", "millimètres de mercure 1"),
    ("kPa 1", "kilopascals 1"),
    ("x°C 1", "xdegrés celsius 1"),
    ("x°F 1", "xdegrés fahrenheit 1"),
    ("U/L 1", "U/litres 1"),
    ("mEq/L 1", "mEq/litres 1"),
    ("mmol/L 1", "mmol/litres 1"),
    ("µmol/L 1", "µmol/litres 1"),
    ("IV 1", "intraveineuse 1"),
    ("IM 1", "intramusculaire 1"),
    ("SC 1", "sous-cutané 1"),
    ("VO 1", "voie orale 1"),
    ("SL 1", "sublinguale 1"),
    ("IN 1", "intranasale 1"),
    ("SAU 1", "service des urgences 1"),
    ("USI 1", "unité de soins intensifs 1"),
    ("REA 1", "réanimation 1"),
    ("ECG 1", "électrocardiogramme 1"),
    ("EEG 1", "électroencéphalogramme 1"),
    ("IRM 1", "imagerie par résonance magnétique 1"),
    ("TDM 1", "tomodensitométrie 1"),
    ("Rx 1", "radiographie 1"),
    ("HTA 1", "hypertension artérielle 1"),
    ("DT2 1", "diabète de type deux 1"),
    ("DT1 1", "diabète de type un 1"),
    ("IMC 1", "indice de masse corporelle 1"),
    ("FC 1", "fréquence cardiaque 1"),
    ("FR 1", "fréquence respiratoire 1"),
    ("TA 1", "tension artérielle 1"),
    ("SaO2 1", "saturation en oxygène 1"),
    ("SpO2 1", "saturation en oxygène 1"),
    ("SO2 1", "saturation en oxygène 1"),
    ("FiO2 1", "fraction inspirée en oxygène 1"),
    ("PaO2 1", "pression partielle en oxygène 1"),
    ("PaCO2 1", "pression partielle en dioxyde de carbone 1"),
    ("INR 1", "rapport normalisé international 1"),
    ("TP 1", "taux de prothrombine 1"),
    ("CRP 1", "protéine C-réactive 1"),
    ("NFS 1", "numération formule sanguine 1"),
    ("BU 1", "bandelette urinaire 1"),
    ("ASA 1", "acide acétylsalicylique 1"),
    ("ACE 1", "enzyme de conversion de l'angiotensine 1"),
    ("AVC 1", "accident vasculaire cérébral 1"),
    ("SCA 1", "syndrome coronarien aigu 1"),
    ("IDM 1", "infarctus du myocarde 1"),
    ("EP 1", "embolie pulmonaire 1"),
    ("TVP 1", "thrombose veineuse profonde 1"),
    ("BPCO 1", "bronchopneumopathie chronique obstructive 1"),
    ("IRC 1", "insuffisance rénale chronique 1"),
    ("IRA 1", "insuffisance rénale aiguë 1"),
    ("ICC 1", "insuffisance cardiaque congestive 1"),
]

#: A spoken command each: what the rules and the older rules must make of it.
DICTATED = [
    ('fièvre virgule toux point', 'Fièvre, toux.', 'Fièvre, toux.'),
    ('a nouveau paragraphe b', 'A\n\nB', 'A b'),
    ('a nouvelle ligne b', 'A\nB', 'A b'),
    ('a à la ligne b', 'A\nB', 'A b'),
    ('a saut de ligne b', 'A\nB', 'A b'),
    ("a point d'interrogation b", 'A? B', 'A? B'),
    ('a points d interrogation b', 'A? B', 'A points d interrogation b'),
    ("a point d'exclamation b", 'A! B', 'A! B'),
    ('a point virgule b', 'A; b', 'A; b'),
    ('a points de suspension b', 'A. . B', 'A. . . B'),
    ('a deux points b', 'A: b', 'A: b'),
    ('a de points b', 'A: b', 'A de points b'),
    ('a des points b', 'A: b', 'A des points b'),
    ('a 2 points b', 'A: b', 'A 2 points b'),
    ('a de pointe b', 'A: b', 'A de pointe b'),
    ('a tiret b', 'A - b', 'A - b'),
    ('a slash b', 'A / b', 'A / b'),
    ('a ouvrez la parenthèse b', 'A ( b', 'A ( b'),
    ('a fermer parenthese b', 'A ) b', 'A ) b'),
    ('a parenthèse ouvrante b', 'A ( b', 'A ( b'),
    ('a parenthèse ouverte b', 'A ( b', 'A ( b'),
    ('a parenthèse fermante b', 'A ) b', 'A ) b'),
    ('a ouvrir les guillemets b', 'A " b', 'A " b'),
    ('a fermez guillemets b', 'A " b', 'A " b'),
    ('a effacer le dernier mot b', 'A effacer le dernier mot b', 'A ⌫ b'),
    ('a annuler b', 'A annuler b', 'A ⌫ b'),
    ("Ouvrez la parenthèse cf annexe fermer la parenthese point d'exclamation", '( cf annexe )!', '( cf annexe )!'),
    ('de pointe  ,, et ; ; puis points virgule saut de ligne ça va ?', ': et puis;\nÇa va', 'De pointe, , et; ; puis points, ça va?'),
    ('', '', ''),
    ('É point été', 'É. Été', 'É. Été'),
    ('a virgule virgule b point point c', 'A, b. C', 'A, , b. . C'),
    ('point \n diag', '.\nDiag', '. Diag'),
]


@pytest.mark.parametrize(
    "f, given, wanted",
    [
        (T.bullet_strip, ["- a", "-- a", "• a", "–a", " * b ", None], ["a", "- a", "a", "–a", "b", None]),
        (T.strip_asr_punctuation, ["fin. 3.5 x, 5. y"], ["fin 3.5 x 5. y"]),
        (T.verbal_commands, ["fièvre virgule toux point", "toux point à la ligne diagnostic deux points pneumonie", "dose 3.5 mg"], ["Fièvre, toux.", "Toux.\nDiagnostic: pneumonie", "Dose 3. 5 mg"]),
        (T.capitalize_sentences, ["abc. def\n\nghi? élan"], ["Abc. Def\n\nGhi? Élan"]),
        (T.fix_question_marks, ["Absence de lésion ?", "Quel est le diagnostic ?", " a ? \n b"], ["Absence de lésion .", "Quel est le diagnostic ?", "a .\nb"]),
        (
            T.normalize_text,
            ["TA 120/80 mmHg", "ECG normal", "Dx: HTA, DT2", "Traitement IV 5mg/kg", "é", None],
            ["tension artérielle 120 80 millimètres de mercure", "électrocardiogramme normal", "dx: hypertension artérielle, diabète de type deux", "traitement intraveineuse 5mg kilogrammes", "é", None],
        ),
        (T.expand_abbreviations, ["5 mmol/L", "3 mg/L", "M. Dupont", "L'examen", "p. ex. ceci", "37°C", "37 °C"], ["5 mmol/litres", "3 milligrammes par litre", "monsieur. Dupont", "litres'examen", "par exempleemple. ceci", "37degrés celsius", "37 °C"]),
        (T.stem, ["a/b/c.tar.gz", "a\\b.wav", "x", ".hid", "a/"], ["c.tar", "b", "x", ".hid", ""]),
        (T.word_count, ["", "  ", " a  b\nc "], [0, 0, 3]),
    ],
)
def test_golden(spark, f, given, wanted):
    assert apply(spark, f, given) == wanted


def test_every_command(spark):
    given, new, old = zip(*DICTATED, strict=True)
    assert apply(spark, T.verbal_commands, given) == list(new)
    assert apply(spark, T.verbal_commands_v1, given) == list(old)


def test_every_abbreviation(spark):
    given, want = zip(*ABBREVIATED, strict=True)
    assert apply(spark, T.expand_abbreviations, given) == list(want)


def test_abbreviations_together(spark):
    given = ["Dr. Mme. Drs vs. etc. cf x", "n°5 c.à.d. cad p ex", "AVC, IDM; EP/TVP", "éDr Drà"]
    want = ["docteur. madame. docteurs versus. et cetera. confer x", "numéro5 c'est à dire cad par exempleemple", "accident vasculaire cérébral, infarctus du myocarde; embolie pulmonaire/thrombose veineuse profonde", "éDr Drà"]
    assert apply(spark, T.expand_abbreviations, given) == want


def test_gates():
    """No pattern matches a text without its gate."""
    import itertools

    for _, _, gate in [*GENERAL_ABBREVIATIONS, *MEDICAL_ABBREVIATIONS, *COMMANDS, *COMMANDS_V1]:
        assert gate and not re.search(r"[\\?*\[(|]", gate)
    spoken = ["".join(x) for x in itertools.product(["point ", "points ", "de pointe "], ["d'", "de ", ""], ["interrogation", "exclamation", "suspension", "virgule", "à la ligne"])]
    for text in [*(d[0] for d in DICTATED), *spoken]:
        for rules in (COMMANDS, COMMANDS_V1):
            for pattern, _, gate in rules:
                if re.search(pattern, text.lower(), re.I):
                    assert gate in text.lower()


def test_normalize(spark):
    given = ["A B\tc", "L’œuvre — à 5 % (ß) ñ_x", "été !?", "日本 3"]
    assert apply(spark, T.normalize_text, given) == ["a b c", "litres œuvre à 5 ß ñ_x", "été !?", "日本 3"]


def test_report_sentences(spark):
    long = "Un. Deux! 3.5 mg? Fin " + "x" * 200
    assert apply(spark, T.report_sentences, ["court\n\nUne ligne entière.", long]) == [["Une ligne entière."], ["Fin " + "x" * 200]]
    assert apply(spark, lambda c: T.report_sentences(c, least=1), [long])[0] == ["Un.", "Deux!", "3.5 mg?", "Fin " + "x" * 200]


def test_block_sentences(spark):
    assert apply(spark, T.block_sentences, ["première\n  ligne\n \n\nbloc deux ici", ""]) == [["première ligne", "bloc deux ici"], []]


def test_combine(spark):
    df = spark.createDataFrame([(["a.", " b ", "", "c.."],), ([""],), ([],)], "t array<string>")
    assert [r[0] for r in df.select(T.combine_transcripts(F.col("t"))).collect()] == ["a. b. c.", ".", "."]


def test_word_error_rate(spark):
    import random

    def edits(r, h):
        row = list(range(len(h) + 1))
        for i, a in enumerate(r, 1):
            old, row[0] = row[0], i
            for j, b in enumerate(h, 1):
                old, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, old + (a != b))
        return row[-1]

    rnd = random.Random(3)
    pairs = [("a b c", "a x c"), ("", ""), ("", "a"), ("A  b", "a B")]
    pairs += [(" ".join(rnd.choices("abcdé", k=rnd.randint(1, 30))), " ".join(rnd.choices("abcdé", k=rnd.randint(0, 30)))) for _ in range(40)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, r string, h string")
    got = [r[1] for r in df.select("i", T.word_error_rate(F.col("r"), F.col("h"))).orderBy("i").collect()]
    want = [(edits(r.lower().split(), h.lower().split()) / len(r.split())) if r.split() else float(bool(h.split())) for r, h in pairs]
    assert got == pytest.approx(want)


def test_dictation_models(spark):
    f = lambda c: T.dictation(c, restore=lambda x: F.concat(x, F.lit(" .ok")), correct=lambda x: F.concat(x, F.lit("?")))
    assert apply(spark, f, ["un texte sans aucune ponctuation du tout ici et encore des mots", "a point"]) == ["Un texte sans aucune ponctuation du tout ici et encore des mots .ok.", "A.."]


def test_word_edits_beyond_codes(spark):
    import random

    words = [f"w{i}" for i in range(36_000)]
    df = spark.createDataFrame([(words, [*words[:-3], "x", "y"]), (["a", "b"], ["b"]), (None, ["b"])], "r array<string>, h array<string>")
    assert [r[0] for r in df.select(T.word_edits(F.col("r"), F.col("h"))).collect()] == [3, 1, None]
    rnd = random.Random(5)
    for _ in range(60):
        r, h = (rnd.choices("abcd", k=rnd.randint(0, 12)) for _ in range(2))
        row = list(range(len(h) + 1))
        for i, a in enumerate(r, 1):
            old, row[0] = row[0], i
            for j, b in enumerate(h, 1):
                old, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, old + (a != b))
        assert T.edit_distance(r, h) == row[-1]


def test_wer_of_whole_turns(spark):
    from glotta.plans import queries

    d = "/root/testdata/sf0.001"
    turns = {(r.conv_id, r.turn): r.text.lower().split() for r in spark.read.parquet(d + "/conversations.parquet").collect()}
    pairs = {k: (r, turns[k[0], k[1] + 1]) for k, r in turns.items() if (k[0], k[1] + 1) in turns}
    edits = {k: T.edit_distance(r, h) for k, (r, h) in pairs.items()}
    got = {(r.conv_id, r.turn): r.wer for r in queries.wer_pairs(spark, d).collect()}
    assert got == pytest.approx({k: edits[k] / len(r) if r else float(bool(h)) for k, (r, h) in pairs.items()}, abs=6e-5)
    total = queries.corpus_wer(spark, d).first()
    assert (total.edits, total.words) == (sum(edits.values()), sum(len(r) for r, _ in pairs.values()))
    assert any(len(r) > 40 for r, _ in pairs.values())
