"""Quality rules: clean line by line first, then reject documents that lost too much.

Every line is judged alone, by punctuation (symbols, exclamation marks, a broken-off end), shouting,
repetition, navigation and boilerplate rules, the last in four languages.  Failing lines are removed; a document whose removed lines held more than ``max_lost`` of
its word characters is rejected, as are documents that fail the base rules (too few words, or too
many words inside repeated three-word windows).

One pass without a shuffle: each text is measured where it was read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tallyforge.llm.common import per_text, words_of

# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"

NAVIGATION = re.compile(r"[|»›•·]|\s>\s")
BOILERPLATE = re.compile(
    r"all rights reserved|licen[sc]ed under|released under the|terms of (?:use|service)|privacy policy"
    r"|cookie|copyright|©|javascript|lorem ipsum|sign (?:in|up)\b|log ?in\b|subscribe|click here"
    r"|read more|share (?:this|on)|powered by"
    # German, French and Spanish pages
    r"|alle rechte vorbehalten|nutzungsbedingungen|datenschutzerkl|impressum\b|weiterlesen|hier klicken|jetzt abonnieren"
    r"|tous droits r[ée]serv|mentions l[ée]gales|conditions d.utilisation|politique de confidentialit|lire la suite|cliquez ici|abonnez-vous"
    r"|todos los derechos reservados|aviso legal|condiciones de uso|pol[íi]tica de privacidad|leer m[áa]s\b|haga clic|suscr[íi]bete|iniciar sesi[óo]n",
    re.IGNORECASE,
)
TEASER = ("...", "…")  # a line that breaks off


@dataclass(frozen=True)
class LineRules:
    """Limits of the line rules.  Shares are of the line's words unless said otherwise."""

    symbols_per_word: float = 0.5
    exclamations_per_word: float = 0.5
    upper_share: float = 0.7  # of the letters
    upper_min_letters: int = 20
    stutter_share: float = 0.5  # words equal to the one before
    stutter_min_words: int = 6
    navigation_marks: int = 2
    navigation_words: float = 4.0  # most words between two marks, on average
    boilerplate_words: int = 25  # longer lines only mention such a phrase
    teaser_words: int = 25  # longer lines may end in an ellipsis
    max_lost: float = 0.5  # of the document's word characters
    min_words: int = 50
    max_repeat_percent: int = 50


def line_fails(line: str, words: list[bytes], rules: LineRules) -> bool:
    """Whether a line with at least one word is to be removed."""
    n = len(words)
    symbols = sum(map(line.count, SYMBOLS))
    if symbols > rules.symbols_per_word * n or line.count("!") > rules.exclamations_per_word * n:
        return True
    if len(line) >= rules.upper_min_letters and not line.islower():
        head = line.swapcase()
        if sum(map(str.islower, head)) > sum(map(str.isupper, head)):  # more capitals than not
            letters = sum(map(str.isalpha, line))
            if letters >= rules.upper_min_letters and sum(map(str.isupper, line)) >= rules.upper_share * letters:
                return True
    if n >= rules.stutter_min_words:
        if sum(map(bytes.__eq__, words, words[1:])) >= rules.stutter_share * n:
            return True
    marks = len(NAVIGATION.findall(line))
    if marks >= rules.navigation_marks and n - marks <= rules.navigation_words * (marks + 1):
        return True
    if n <= rules.teaser_words and line.rstrip(SPACES).endswith(TEASER):
        return True
    return n <= rules.boilerplate_words and BOILERPLATE.search(line) is not None


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more, first occurrences included."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    first: dict[tuple, int] = {}
    covered = bytearray(len(words))
    for i, window in enumerate(windows):
        j = first.setdefault(window, i)
        if j != i:
            covered[j : j + 3] = covered[i : i + 3] = b"\1\1\1"
    return sum(covered)


def judge(text: str | None, rules: LineRules = LineRules()) -> tuple:
    """Base counts, verdict and cleaned text of one document; see ``quality_rules``."""
    words = words_of(text)
    n_words = len(words)
    text = text or ""
    word_chars = len(text) - sum(map(text.count, SPACES))
    n_symbols = sum(map(text.count, SYMBOLS))
    n_repeat = repeated_words(words)
    seen: set[str] = set()
    kept_lines, n_dup, lost, n_removed = [], 0, 0, 0
    for line in text.split("\n"):
        line_words = words_of(line)
        if line_words:
            n_dup += line in seen
            seen.add(line)
            if line_fails(line, line_words, rules):
                n_removed += 1
                lost += len(line) - sum(map(line.count, SPACES))
                continue
        kept_lines.append(line)
    base_failed = n_words < rules.min_words or 100 * n_repeat > rules.max_repeat_percent * n_words
    kept = not base_failed and lost <= rules.max_lost * word_chars
    return n_words, word_chars, n_symbols, n_dup, n_repeat, base_failed, kept, n_removed, lost, "\n".join(kept_lines)


SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, n_lines_removed long, chars_removed long, clean_text string"
)


def quality_rules(docs: DataFrame, text: str = "text", rules: LineRules = LineRules()) -> DataFrame:
    """All documents with their measures, the verdict ``kept`` and the cleaned text.

    Null and empty texts have no words and fail the base rules.  Rows are judged one by one, so
    repeated rows get equal results; a column of the input that has the name of a result is
    replaced; an empty table gives an empty table.
    """
    return per_text(docs, text, SCHEMA, lambda t: judge(t, rules))
