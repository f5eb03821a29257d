"""Line-first cleaning: lines that break a rule go, documents that lose too much text are rejected.

A line's rules look at its punctuation (symbols, exclamation marks, words in capitals), at repetition within it, at navigation
(lines of menu words or with separators) and at boilerplate phrases: a line of any length goes if it holds a phrase, and phrases and
menu words cover ``COVERED`` of its words, so that prose that mentions a phrase stays. The lists are in four languages. The document's own rules are its length
in words and the share of words inside repeated eight-word windows.

Defined cases: a null text has no words; an empty text or one of blanks is rejected as too short; a line without words is kept
and counts for nothing; repeated rows are judged alike; an empty table gives no rows. All other columns stay as they are.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from censusmart.llm.storage import unused

MIN_WORDS = 20
WINDOW = 8
MAX_REPEATED = 30  # per cent of the words
MIN_KEPT = 0.5  # share of the words' characters
SYMBOLS = "#*$%&|<>"
MAX_SYMBOL_WORDS = 0.3
MAX_SHOUTED = 0.5
MAX_ECHOED = 0.3
MENU_WORDS_SHARE = 0.6
COVERED = 0.35

# Words of menus and phrases of boilerplate in English, French, German and Spanish, in small letters.
MENU = frozenset(
    "home login logout register menu search next previous prev back top share print contact about help faq sitemap subscribe newsletter "
    "facebook twitter instagram more skip navigation "
    "accueil connexion déconnexion inscription recherche rechercher suivant précédent retour haut partager imprimer aide abonnement "
    "startseite anmelden abmelden registrieren menü suche suchen weiter zurück oben teilen drucken kontakt hilfe impressum datenschutz "
    "inicio entrar salir registrarse menú buscar búsqueda siguiente anterior volver arriba compartir imprimir contacto ayuda suscribirse".split())
PHRASES = (
    r"all rights reserved", r"licensed under(?: the (?:\S+ ){1,4}?licen[sc]e(?:,? version [\d.]+)?)?", r"released under the", r"terms of (?:use|service)",
    r"privacy policy", r"cookie policy", r"(?:we|site|website) uses? (?:\w+ )?cookies", r"accept (?:all |our |the )*(?:use of )?cookies",
    r"uses? (?:all )?cookies", r"enable javascript", r"click here", r"lorem ipsum",
    r"(?:©|\(c\)|copyright)(?: (?:©|\(c\)))? \d{4}(?: ?[-–] ?\d{4})?", r"you may not use this (?:file|software|work)",
    r"except in compliance with the license", r"you may obtain a copy of the license", r"distributed on an .?as is.? basis",
    r"without warrant(?:y|ies)(?: or conditions)? of any kind", r"(?:software )?is provided .?as is", r"permission is hereby granted,? free of charge",
    r"by (?:continuing|using) (?:to (?:use|browse)|this|our)(?: (?:this|our|the))?(?: (?:web)?site)?", r"improve your (?:browsing )?experience",
    r"tous droits réservés", r"politique de confidentialité", r"conditions (?:générales )?d['’]utilisation", r"mentions légales",
    r"gestion des cookies", r"(?:ce site|nous) utilis(?:e|ons) des cookies", r"cliquez ici",
    r"alle rechte vorbehalten", r"datenschutzerklärung", r"allgemeine geschäftsbedingungen", r"nutzungsbedingungen",
    r"(?:diese (?:web)?seite|wir) verwende[nt] cookies", r"cookie-einstellungen", r"hier klicken|klicken sie hier",
    r"todos los derechos reservados", r"política de (?:privacidad|cookies)", r"términos (?:y condiciones|de uso)", r"aviso legal",
    r"(?:este sitio(?: web)?|nosotros) (?:utiliza|usa|utilizamos|usamos) cookies", r"haga clic aquí",
)
BOILERPLATE = re.compile("|".join(PHRASES))
# Every phrase holds one of these, so that a text or line without any is not searched for the phrases.
TRIGGERS = ("reserv", "réserv", "vorbehalten", "licen", "released", "terms", "términos", "policy", "politique", "política", "cookie", "javascript",
            "click", "cliquez", "klicken", "clic", "lorem", "©", "(c)", "copyright", "not use this", "basis", "warrant", "as is",
            "permission", "continuing", "using", "experience", "conditions", "mentions", "datenschutz", "bedingungen", "aviso")
_BLANKS = " \t\n\x0b\x0c\r"
_SYMBOL = re.compile(r"[#*$%&|<>]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_OTHER_BLANKS = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_SEPARATORS = re.compile(r"[|»›•·>]")


def line_fails(line: str, words: list[str], suspect: bool = True) -> str | None:
    """The rule that a line with these words breaks, or None; a line that is not ``suspect`` holds no boilerplate phrase."""
    n = len(words)
    if _SYMBOL.search(line) and sum(_SYMBOL.search(w) is not None for w in words) > MAX_SYMBOL_WORDS * n:
        return "symbols"
    if n >= 3 and sum(map(str.isupper, words)) > MAX_SHOUTED * n or line.count("!!") > MAX_SHOUTED * n:
        return "shouting"
    if n >= 6 and sum(map(eq, words, islice(words, 1, None))) > MAX_ECHOED * n:
        return "echo"
    menu = sum(w.strip(".,:;|»›•·>").lower() in MENU for w in words)
    if menu >= MENU_WORDS_SHARE * n or len(_SEPARATORS.findall(line)) >= max(2, n // 3):
        return "navigation"
    return "boilerplate" if suspect and covered_by_phrases(line, n) else None


def triggered(lowered: str) -> bool:
    return any(t in lowered for t in TRIGGERS)


def covered_by_phrases(line: str, n: int) -> bool:
    """Whether phrases and menu words make up ``COVERED`` of the line's ``n`` words."""
    lowered = line.lower()
    if not triggered(lowered):
        return False
    left, phrases = BOILERPLATE.subn(" ", lowered)
    if not phrases:
        return False
    plain = sum(any(map(str.isalnum, w)) and w.strip(".,:;|»›•·>") not in MENU for w in words_of(left))
    return n - plain >= COVERED * n


def words_of(text: str) -> list[str]:
    """The words, ended by the six ASCII blanks only; str.split knows more blanks, so it serves texts without those."""
    return _WORD.findall(text) if _OTHER_BLANKS.search(text) else text.split()


def repeated_words(words: list[str]) -> int:
    """Words that lie in an eight-word window which occurs twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    joined = " ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths + 1) - lengths - 1
    windows = [joined[a:b] for a, b in zip(starts[:n].tolist(), (starts + lengths)[WINDOW - 1:].tolist())]
    if len(set(windows)) == n:
        return 0
    counts = Counter(windows)
    edge = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(np.fromiter((counts[w] > 1 for w in windows), bool, n))
    np.add.at(edge, at, 1)
    np.add.at(edge, at + WINDOW, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def judged(text: str | None) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, kept_text)."""
    text = text or ""
    words = words_of(text)
    n_words = len(words)
    word_chars = len(text) - sum(map(text.count, _BLANKS))
    n_symbols = sum(map(text.count, SYMBOLS))
    seen, n_dup, stay, stay_chars = set(), 0, [], 0
    suspect = triggered(text.lower())
    for line in text.split("\n"):
        own = words_of(line)
        if own:
            n_dup += line in seen
            seen.add(line)
            if line_fails(line, own, suspect):
                continue
            stay_chars += sum(map(len, own))
        stay.append(line)
    n_repeat = repeated_words(words)
    base_failed = n_words < MIN_WORDS or 100 * n_repeat > MAX_REPEATED * n_words
    kept = not base_failed and stay_chars >= MIN_KEPT * word_chars
    return n_words, word_chars, n_symbols, n_dup, n_repeat, base_failed, kept, "\n".join(stay) if kept else None


_KINDS = (pa.int64(),) * 5 + (pa.bool_(), pa.bool_(), pa.string())
_SCHEMA = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, kept_text string"


def judge_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", with_text: bool = True) -> DataFrame:
    """One row per document: its id, counts, verdicts and, with ``with_text``, the text without the lines that broke a rule."""
    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    names = [c.split()[0] for c in _SCHEMA.split(", ")][:8 if with_text else 7]
    kind = chosen.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [judged(t.as_py()) for t in batch.column(1)]
            columns = list(zip(*rows)) or [()] * 8
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns[:len(names)], _KINDS))],
                                             names=["doc_id", *names])

    return chosen.mapInArrow(run, f"doc_id {kind}, " + ", ".join(_SCHEMA.split(", ")[:len(names)]))


def clean_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """The kept documents with all their columns; their text is without the lines that broke a rule."""
    names, at, verdict = docs.columns, docs.columns.index(text), unused("verdict", docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [judged(t.as_py()) for t in batch.column(at)]
            stay = pa.array([r[6] for r in rows], pa.bool_())
            columns = [pa.array([r[7] for r in rows], pa.string()) if i == at else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays([*columns, stay], names=[*names, verdict]).filter(stay)

    schema = T.StructType([*docs.schema.fields, T.StructField(verdict, T.BooleanType())])
    return docs.mapInArrow(run, schema).select(*[F.col(f"`{c}`") for c in names])
