"""Template residue, filler text, error pages and script notices in place of content.

A multi-pattern automaton (Aho-Corasick) finds the known phrases of all languages in one
pass over a text; patterns add what varies: placeholders, tracebacks, gibberish after
"Lorem ipsum", keyboard filler. A sentence or line counts as residue if matches cover
enough of it, so an article that quotes a message ("der Hinweis ›Bitte aktivieren Sie
JavaScript‹, der ...") holds none. Site navigation and a bare title are neither residue
nor content. A document is a case if residue covers it, or if at most one real sentence
stands beside the residue.

Exit: placeholders, tracebacks, gibberish and keyboard filler have no fixed phrases; there
the patterns decide alone (README gives the figures).

Defined results: null, empty and blank texts are no cases (they hold no residue); texts
are scanned whole; repeated rows count once; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import product
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame

# The parts that messages are made of, by language and kind. A message is a
# part of each list of a row, in this order, with blanks between them.
MESSAGES: list[tuple[list[str], ...]] = [
    # scripts are required
    (["you need to", "you must", "please"], ["enable", "activate", "turn on"], ["javascript", "scripts", "cookies"]),
    (["to run this app", "to view this page", "to use this site", "to continue", "um fortzufahren", "pour continuer"],),
    (["enable", "activate", "turn on", "switch on", "allow"], ["javascript", "scripts", "cookies", "javascript and cookies", "scripts for this site"]),
    (["javascript", "scripts", "cookies"], ["is", "are", "must be"], ["disabled", "required", "not enabled", "enabled", "turned off", "switched off"]),
    (["this"], ["page", "site", "app", "application", "website"], ["requires", "needs"], ["javascript", "scripts", "cookies"]),
    (["your browser does not support"], ["javascript", "scripts"]),
    (["aktivieren sie", "erlauben sie", "benötigt", "erfordert", "unterstützt kein", "unterstützt keine", "läßt sich nicht ohne", "läßt sich ohne", "lässt sich ohne"], ["javascript", "skripte", "skripten", "cookies", "skripte nicht laden"]),
    (["schalten sie"], ["javascript", "skripte", "cookies", "skripte und cookies", "javascript und cookies"], ["ein", "an"]),
    (["javascript", "skripte", "cookies", "skripte und cookies"], ["ist", "sind", "muß", "muss", "müssen"], ["deaktiviert", "abgeschaltet", "ausgeschaltet", "erforderlich", "aktiviert sein", "eingeschaltet sein"]),
    (["ohne skripte kann die prüfung nicht fortgesetzt werden", "diese seite benötigt javascript", "ihr browser ist veraltet", "ihr browser unterstützt keine skripte", "in ihrem browser, um diesen artikel anzuzeigen"],),
    (["activez", "activer", "autorisez", "nécessite", "ne prend pas en charge"], ["javascript", "les scripts", "le javascript"]),
    (["javascript est désactivé", "javascript est requis", "javascript doit être activé", "pour afficher cette notice"],),
    (["active", "habilite", "activar", "habilitar", "requiere", "attiva", "abilita", "attivare", "abilitare", "richiede", "ative o", "habilite o", "requer"], ["javascript"]),
    (["javascript está"], ["desactivado", "deshabilitado", "desativado"]),
    (["javascript è disabilitato", "schakel javascript in", "javascript is uitgeschakeld", "deze pagina vereist javascript"],),
    (["content is", "page is", "inhalt wird", "seite wird", "artikel wird"], ["loading", "being loaded", "geladen"]),
    (["loading …", "loading...", "laden …", "chargement", "cargando", "caricamento in corso", "reload the page", "laden sie die seite neu"],),
    # errors, access, checks
    (["page", "file", "document", "article", "resource", "url"], ["not found", "cannot be found", "could not be found", "was not found", "does not exist", "no longer exists", "is unavailable", "has been moved"]),
    (["seite", "datei", "dokument", "artikel", "eintrag"], ["nicht gefunden", "wurde nicht gefunden", "konnte nicht gefunden werden", "existiert nicht", "existiert nicht oder wurde verschoben", "nicht verfügbar", "ist nicht erreichbar", "wird gerade gewartet"]),
    (["page", "fichier", "document", "article"], ["introuvable", "non trouvée", "non trouvé", "demandée est introuvable", "demandé est introuvable", "n'existe pas"]),
    (["página no encontrada", "la página solicitada no existe", "pagina non trovata", "la pagina richiesta non esiste", "pagina niet gevonden", "página não encontrada"],),
    (["access", "zugriff", "accès", "acceso", "accesso", "toegang"], ["denied", "forbidden", "verweigert", "nicht erlaubt", "refusé", "interdit", "denegado", "negato", "geweigerd"]),
    (["internal", "interner", "internal server", "erreur", "server"], ["error", "fehler", "interne", "serverfehler", "interne du serveur"]),
    (["service", "dienst", "site", "server"], ["unavailable", "temporarily unavailable", "temporairement indisponible", "vorübergehend nicht verfügbar", "under maintenance", "en maintenance"]),
    (["too many requests", "zu viele anfragen", "trop de requêtes", "demasiadas solicitudes", "troppe richieste", "bad gateway", "gateway timeout", "gateway time-out", "request timed out", "zeitüberschreitung"],),
    (["session", "sitzung", "your session", "ihre sitzung"], ["expired", "has expired", "abgelaufen", "ist abgelaufen", "expirée"]),
    (["please", "bitte"], ["log in", "sign in", "try again later", "melden sie sich an", "erneut anmelden", "wait", "warten sie"]),
    (["veuillez"], ["vous connecter", "réessayer plus tard", "patienter"]),
    (["you do not have permission", "sie haben keine berechtigung", "vous n'avez pas l'autorisation", "diesen eintrag zu sehen", "the server could not complete your request", "something went wrong", "an error occurred", "ein fehler ist aufgetreten", "une erreur est survenue"],),
    (["der vorgang wurde abgebrochen", "wenden sie sich an die verwaltung dieser seite", "die verbindung zur datenquelle ist derzeit nicht möglich", "warten sie einige sekunden", "wartungsarbeiten", "under maintenance", "kein inhalt verfügbar", "no content available"],),
    (["versuchen sie es"], ["in einigen minuten erneut", "später erneut", "noch einmal"]),
    (["prüfung läuft", "ihre anfrage wird geprüft", "einen augenblick", "checking your browser", "verify you are human", "confirm you are not a robot", "vérification en cours", "zurück zur startseite", "back to home page", "retour à l'accueil"],),
    (["bestätigen sie, daß sie", "bestätigen sie, dass sie"], ["kein automat sind", "kein roboter sind", "ein mensch sind"]),
    (["traceback (most recent call last)", "fatal: query failed"],),
    # filler
    (["lorem ipsum", "dies ist ein blindtext", "platz für ihren text", "mustertext ohne inhalt", "blindtext bis zur freigabe", "hier steht später der artikel", "text einfügen", "absatz ergänzen", "beispieltext", "… folgt …", "in vorbereitung"],),
    (["der text", "text", "inhalt", "der inhalt", "der artikel"], ["folgt", "folgt in kürze", "wird ergänzt"]),
    (["this is sample text", "sample text for", "placeholder text", "insert text here", "to be done", "to be determined", "texte d'exemple", "ceci est un texte d'exemple", "texto de ejemplo", "testo di esempio"],),
    (["content", "text", "article", "contenu", "texte"], ["coming soon", "to follow", "à venir", "goes here"]),
]
KEYBOARD = {"qwertz", "qwerty", "azerty", "asdf", "asdfgh", "jklö", "jkl", "xxx", "bla", "blah", "test", "yxcv", "foo", "bar"}
NAVIGATION = re.compile(
    r"^(?=.{3,120}$)(?:[^\n.!?]*(?:\s[|·›–»]\s|\s{4,})[^\n.!?]*|(?:sie sind hier|you are here|vous êtes ici)\s*:.*)$", re.I
)
PLACEHOLDER = re.compile(
    r"\{\{\s*[\w.]+\s*\}\}|\{%=?\s*[\w.]+\s*%\}|<%=?\s*[\w.]+\s*%>|<<\s*\w+\s*>>|\$\{\s*\w+\s*\}|@@\w+@@|%[A-Za-z]\w+%|__[A-Za-z]\w*?__(?!\w)|\{[A-Za-z]\w{2,}\}|\[[A-Za-zäöüß_]\w{2,}\]|##\w+##|\[\[\w+\]\]|#\{\w+\}"
)
MARKS = re.compile(r"^(?:TBD|TODO\b.*|FIXME\b.*|N\. ?N\.|\?{2,}|\[[^\]\n]{2,40}\]|(?:…|\.\.\.) ?\w+ ?(?:…|\.\.\.)|-{3,}|\.{3,}|…)$")
TECHNICAL = re.compile(r"^(?:\s*File \".*|\s+\w+ = .*|\w*(?:Error|Exception)\b.*|Fatal: .*|(?:Error|Erreur|Fehler|HTTP)\s*\d{3}\b.*|[1-5]\d{2} [–-] .*|[45]\d{2}(?: [A-Z][a-z]+){1,4}|(?:Request id|Vorgang|Code)\b.*)$")
SENTENCE = re.compile(r"[^.!?…\n]*(?:[.!?…](?![.!?…]*\s)[^.!?…\n]*)*[.!?…]+(?=\s|$)|[^\n]+")
TAIL = re.compile(r"(?:Vorgang|Request id:?|Code:?)\s*[0-9a-f]+", re.I)
QUOTED = re.compile(r"›[^›‹]*‹|„[^„“]*“|\"[^\"]*\"|«[^«»]*»|»[^«»]*«")


KEYS = re.compile(rf"\b(?:{'|'.join(sorted(KEYBOARD))})\b")


@lru_cache(1)
def automaton() -> Any:
    """The automaton of all phrases."""
    import ahocorasick

    out = ahocorasick.Automaton()
    for row in MESSAGES:
        for parts in product(*row):
            out.add_word(phrase := " ".join(parts), len(phrase))
    out.make_automaton()
    return out


def lowered(text: str) -> str:
    """Lower case of the same length: what would become longer stays as it is."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def _covered(text: str, low: str) -> int:
    """Characters of a sentence under phrases, placeholders and technical patterns."""
    marked = bytearray(len(text))
    for end, n in automaton().iter(low):
        marked[end - n + 1 : end + 1] = b"\1" * n
    for pattern in (PLACEHOLDER, TAIL):
        for hit in pattern.finditer(text):
            marked[hit.start() : hit.end()] = b"\1" * (hit.end() - hit.start())
    return sum(marked)


def is_residue(sentence: str) -> bool:
    """Is this sentence or line residue?"""
    s = sentence.strip()
    if not s:
        return False
    if MARKS.match(s) or TECHNICAL.match(sentence.rstrip()):
        return True
    low = lowered(s)
    if low.startswith("lorem ipsum"):
        return True
    words = re.findall(r"\w+", low)
    if len(words) >= 3 and sum(w in KEYBOARD for w in words) >= 0.8 * len(words):
        return True
    places = PLACEHOLDER.findall(s)
    if len(places) >= 2 or places and sum(map(len, places)) >= 0.12 * len(s):
        return True
    bare = QUOTED.sub(" ", s)
    return _covered(bare, lowered(bare)) >= 0.45 * max(1, len(re.sub(r"\s+", " ", bare).strip(" .!?")))


def _marked(text: str) -> bool:
    """Does a line or sentence of the text match MARKS, TECHNICAL or TAIL?"""
    if TAIL.search(text):
        return True
    for line in text.split("\n"):
        if line.strip() and (MARKS.match(line.strip()) or TECHNICAL.match(line.rstrip()) or any(MARKS.match(x.strip()) or TECHNICAL.match(x.rstrip()) for x in SENTENCE.findall(line))):
            return True
    return False


def judge(text: str | None) -> bool:
    """Is the document residue in the place of an article?"""
    if not text or not text.strip():
        return False
    low = lowered(text)
    # One pass over the whole text decides whether to look closer: anything that
    # ``is_residue`` accepts holds a phrase, a placeholder, a mark or a keyboard word.
    if next(automaton().iter(low), None) is None and not PLACEHOLDER.search(text) and not KEYS.search(low) and not _marked(text):
        return False
    residue = real = sentences = 0
    for line in text.split("\n"):
        s = line.strip()
        if not s or NAVIGATION.match(s):
            continue
        if not re.search(r"[.!?:…\d\]\}>%@_]$", s) and len(s) < 70 and len(s.split()) <= 4 and not is_residue(line):
            continue  # a title
        for part in [line] if TECHNICAL.match(line) else SENTENCE.findall(line):
            if not part.strip():
                continue
            if is_residue(part):
                residue += len(part.strip())
            elif len(part.split()) >= 3:
                real += len(part.strip())
                sentences += 1
    return residue > 0 and (sentences <= 1 or residue >= 0.5 * (residue + real))


def found(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Distinct keys of the documents that are residue."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.loc[[judge(t) for t in batch[text]], [key]]

    kind = dict(documents.dtypes)[key]
    return documents.select(key, text).mapInPandas(read, f"`{key}` {kind}").distinct()
