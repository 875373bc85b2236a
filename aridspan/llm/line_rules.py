"""Quality rules, line first: each line is judged by punctuation, navigation and boilerplate
rules, failing lines go, and a document that loses too much of its text is rejected.

One pass in Arrow batches without a shuffle, so neither hot sources nor groups of copies matter.

Defined cases: a null text has no words and no lines (counts 0, base_failed, not kept, clean_text
null); an empty text likewise with clean_text empty; repeated rows are each judged alone; an empty
table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from aridspan.llm.common import blocks, table, texts

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, n_lines long, n_bad_punctuation long, n_navigation long, "
    "n_boilerplate long, lost_chars long, clean_text string"
)

SPACES = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
#: Bytes that may end a sentence: ASCII marks and closing quotes or brackets ...
ENDS = b".!?:;,\"')]"
#: ... and longer marks.
WIDE_ENDS = tuple(x.encode() for x in "…”’»。！？；：」』）؟۔।")
#: The end of a sentence within a line.
INNER_END = re.compile(b"[.!?] ")
#: What stands between the entries of a menu.
SEPARATORS = re.compile(b"\\||>|\xe2\x80\xba|\xc2\xbb|\xc2\xb7|\xe2\x80\xa2")
#: Entries of menus and phrases of boilerplate (patterns), by language. A-Z is lower-cased before they are looked for, other
#: letters are not. Every list holds for every text, as sites mix languages; words that often stand alone are left out.
MENUS = {
    "en": "home login logout register search menu sitemap contact about help faq next previous share print "
    "subscribe download upload cart checkout account settings profile top back more",
    "de": "startseite anmelden abmelden registrieren suche suchen menü übersicht impressum kontakt hilfe zurück drucken warenkorb kasse "
    "konto einstellungen profil datenschutz agb",
    "es": "inicio registrarse buscar menú contacto ayuda siguiente anterior compartir imprimir carrito cuenta ajustes perfil volver",
    "fr": "accueil connexion déconnexion inscription rechercher recherche contactez aide suivant précédent partager imprimer panier "
    "compte paramètres profil retour",
}
BOILERPLATE = {
    "en": "all rights reserved|terms of (?:use|service)|privacy policy|cookie policy|(?:uses?|accept(?: all)?) cookies"
    "|lorem ipsum|enable javascript|javascript (?:is|must be)|click here|read more|sign up for|powered by"
    "|subscribe to our|follow us on|skip to (?:main )?content|copyright (?:©|\\(c\\))",
    "de": "alle rechte vorbehalten|nutzungsbedingungen|datenschutzerklärung|(?:verwende[nt]|nutz(?:en|t)) cookies|cookies (?:akzeptieren|zulassen)"
    "|javascript (?:muss|aktivieren)|hier klicken|klicken sie hier|weiterlesen|newsletter (?:abonnieren|anmelden)|zum inhalt springen",
    "es": "todos los derechos reservados|(?:términos|condiciones) de uso|política de (?:privacidad|cookies)|(?:usa(?:mos)?|utiliza(?:mos)?|aceptar) cookies"
    "|activar? javascript|(?:haga|haz) clic aquí|leer más|suscríb(?:ase|ete) a|(?:saltar|ir) al contenido",
    "fr": "tous droits réservés|conditions (?:générales )?(?:d(?:\\x27|’)utilisation|de vente)|politique de confidentialité|mentions légales"
    "|(?:utilise|utilisons|accepter) (?:des |les )?cookies|activer javascript|cliquez ici|lire la suite|abonnez-vous|aller au contenu",
}
MENU_WORDS = frozenset(w.encode() for words in MENUS.values() for w in words.split())
PHRASES = re.compile("|".join(BOILERPLATE.values()).encode())


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more in the text, the first occurrence included."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    count = Counter(windows)
    covered = reach = 0
    for i, window in enumerate(windows):
        if count[window] > 1:
            covered += i + 3 - max(i, reach)
            reach = i + 3
    return covered


def line_fault(line: bytes) -> int:
    """0: the line stays; 1: no sentence ends in it or with it, or a symbol for every third word; 2: navigation; 3: boilerplate."""
    words = line.split()
    low = line.lower()
    if PHRASES.search(low):
        return 3
    parts = len(SEPARATORS.findall(line))
    if parts >= 2 and len(words) <= 4 * (parts + 1):
        return 2
    if len(words) <= 6 and sum(w.strip(b".,:;!?") in MENU_WORDS for w in low.split()) * 2 >= len(words):
        return 2
    if line[-1] not in ENDS and not line.endswith(WIDE_ENDS) and not INNER_END.search(line):
        return 1
    symbols = len(line) - len(line.translate(None, SYMBOLS))
    return int(symbols >= 3 and 3 * symbols >= len(words))


def judge(text: bytes | None, max_lost: float) -> tuple:
    """The columns of SCHEMA after doc_id, for one text."""
    if text is None:
        return 0, 0, 0, 0, 0, True, False, 0, 0, 0, 0, 0, None
    words = text.split()
    bare = text.translate(None, SPACES)
    chars = len(bare.decode())
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    repeats = repeated_words(words)
    base_failed = len(words) < 50 or 100 * repeats > 50 * len(words)
    seen: set[bytes] = set()
    stay, faults = [], [0, 0, 0, 0]
    dup = lines = lost = 0
    for line in text.split(b"\n"):
        core = line.strip(SPACES)
        if not core:
            stay.append(line)
            continue
        lines += 1
        dup += line in seen
        seen.add(line)
        fault = line_fault(core)
        faults[fault] += 1
        if fault:
            lost += len(core.translate(None, SPACES).decode())
        else:
            stay.append(line)
    kept = not base_failed and lost <= max_lost * chars
    clean = b"\n".join(stay).decode()
    return len(words), chars, symbols, dup, repeats, base_failed, kept, lines, *faults[1:], lost, clean


def clean_lines(docs: DataFrame, max_lost: float = 0.5) -> DataFrame:
    """Returns SCHEMA, one row for each row of docs (doc_id, text). lost_chars counts the word characters
    of removed lines; a document is kept if the base rules pass and at most max_lost of its word
    characters went."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None
        for block in blocks(batches, "text"):
            rows = [judge(t, max_lost) for t in texts(block)]
            columns = list(zip(*rows)) or [()] * 13
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.int64()] * 5 + [pa.string()]
            arrays = [block.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds))]
            schema = schema or [f.split()[0] for f in SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays(arrays, schema)

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, SCHEMA)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns, and what the line rules removed; clean_chars is measured on the cleaned text."""
    out = clean_lines(table(spark, sf_dir, "documents"))
    return out.selectExpr("* except (clean_text)", "cast(char_length(clean_text) as long) clean_chars")
