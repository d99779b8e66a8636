"""Text columns: normalisation, repair, titles, tokens, script detection.

Null text counts as empty. All but `repair_mojibake` and `clean_text` are Catalyst expressions.
"""

from __future__ import annotations

import html
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..shipping import arrow_udf

#: Shares of the text after which a tail marker ends it.
TAIL_SHARE = 0.8

# Characters of a text that the judge reads.
JUDGE_CHARS = 2400

# Markers of related-story blocks and tails.
RELATED_BLOCK = r"(?is)Recommended Stories\s+list of \d+ items?.*?end of list"
TAIL_MARKERS = r"(?i)(?:Читайте также|Related (?:Stories|Articles|Coverage|News)|Most (?:Read|Popular)|You may also like|Follow us on)"

# Signs of text decoded with the wrong character set, and what each weighs.
_REPLACEMENT, _REPLACEMENT_WEIGHT = "\ufffd", 50
_SIGNS, _SIGN_WEIGHT = ("Ã", "Â", "Ð", "Ñ", "â", "ð", "Г", "Р", "С", "в"), 2
_SEQUENCES, _SEQUENCE_WEIGHT = ("вЂ", "в€™", "в€œ", "вЂќ", "вЂ“", "вЂ—", "Гј", "Г–", "Г©", "Г¤", "Г¶", "Г„"), 5
#: A wrong decoding shows in one of these, as others can't be encoded back.
_SUSPECT = "[ÃÂÐÑâð]"


def text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def collapse(c: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    # A single space stays as it is, so that only other white space and runs cost a replacement.
    return F.trim(F.regexp_replace(text(c), r"(?U)\s{2,}|[^\S ]", " "))


def normalize(c: Column) -> Column:
    return F.lower(collapse(c))


def left(c: Column, n: int) -> Column:
    return F.substring(text(c), 1, n)


def _weight(s: str) -> int:
    return s.count(_REPLACEMENT) * _REPLACEMENT_WEIGHT + sum(map(s.count, _SIGNS)) * _SIGN_WEIGHT + sum(map(s.count, _SEQUENCES)) * _SEQUENCE_WEIGHT


def _repaired(s: str) -> str:
    """Up to three rounds of encoding back; a round stands only if fewer signs are left."""
    for _ in range(3):
        now, best = _weight(s), s
        for charset in ("latin-1", "cp1252"):
            try:
                other = s.encode(charset).decode("utf-8")
            except UnicodeError:
                continue
            if _weight(other) < _weight(best):
                best = other
        if _weight(best) >= now:
            break
        s = best
    return s


_INVISIBLE = {0xA0: " ", 0x200B: None, 0x200C: None, 0x200D: None, 0xFEFF: None}


def _cleaned(s: str) -> str:
    s = _repaired(html.unescape(unicodedata.normalize("NFKC", _repaired(s))))
    return re.sub(r"\s+", " ", s.translate(_INVISIBLE)).strip()


def _repair_batch(s: pd.Series) -> pd.Series:
    return s.map(_repaired)


_repair_udf = arrow_udf(_repair_batch, "string")


def _clean_batch(s: pd.Series) -> pd.Series:
    return s.map(_cleaned)


_clean_udf = arrow_udf(_clean_batch, "string")


def repair_mojibake(c: Column) -> Column:
    """UTF-8 that was read as Latin-1 or Windows-1252, read right. Python sees only suspect rows."""
    return F.when(text(c).rlike(_SUSPECT), _repair_udf(text(c))).otherwise(text(c))


def clean_text(c: Column) -> Column:
    """Repair, NFKC, entities, repair again, no invisible characters, white space collapsed."""
    plain = text(c).rlike(r"^[\x20-\x25\x27-\x7e\n\r\t]*$")
    return F.when(plain, collapse(c)).otherwise(_clean_udf(text(c)))


def strip_related_blocks(c: Column) -> Column:
    """Without blocks of other stories, and cut at the first tail marker if that stands in the last fifth."""
    body = F.regexp_replace(text(c), RELATED_BLOCK, " ")
    before = F.element_at(F.split(body, TAIL_MARKERS, 2), 1)
    late = body.rlike(TAIL_MARKERS) & (F.length(before) >= TAIL_SHARE * F.length(body))
    return collapse(F.when(late, before).otherwise(body))


def strip_suffix(c: Column, suffix: Column) -> Column:
    """Without `suffix` where the text ends with it; a null suffix changes nothing."""
    has = suffix.isNotNull() & (F.length(suffix) > 0) & F.endswith(text(c), suffix)
    return F.when(has, F.trim(F.substring(text(c), F.lit(1), F.length(text(c)) - F.length(suffix)))).otherwise(text(c))


# The byline of a listing, a card's date footer, its labels and its repetition, a site's name after a title.
BYLINE = r"^(.*?)\bBy [A-Z][a-zA-Z'-]+(?: [A-Z][a-zA-Z'-]+){1,3}\b\s+\S"
CARD_FOOTER = r"\s*\bDate Date\b.*$"
CARD_LABEL = r"^(?:Press release|Media advisory|Project Update|News Item|Story)\s+"
CARD_TWICE = r"^(.+?) \1$"
SITE_NAME = r"\s+-\s+[^-]{2,60}$"


def strip_byline(title: Column) -> Column:
    """The part of a listing's title before `By First Last ...`, unless nothing is left."""
    head = F.trim(F.regexp_extract(text(title), BYLINE, 1))
    return F.when(head != "", head).otherwise(text(title))


def strip_card(title: Column) -> Column:
    """A listing card's title without its label, date footer and repetition, unless nothing is left."""
    out = F.regexp_replace(text(title), CARD_FOOTER, "")
    out = F.trim(F.regexp_replace(out, CARD_LABEL, ""))
    twice = F.regexp_extract(out, CARD_TWICE, 1)
    out = F.when(twice != "", twice).otherwise(out)
    return F.when(out != "", out).otherwise(text(title))


def strip_site_name(title: Column) -> Column:
    """Without ` - Site` of 2 to 60 characters at the end."""
    return F.regexp_replace(text(title), SITE_NAME, "")


def slugify(title: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(text(title)), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def _slug_batch(s: pd.Series) -> pd.Series:
    plain = lambda x: unicodedata.normalize("NFD", x.lower()).encode("ascii", "ignore").decode()
    return s.map(lambda x: re.sub("[^a-z0-9]+", "_", plain(x)).strip("_"))


_slug_udf = arrow_udf(_slug_batch, "string")


def place_code(name: Column) -> Column:
    """A name without accents, as lower-case words joined by underscores."""
    return F.when(text(name).rlike(r"[^\x00-\x7f]"), _slug_udf(text(name))).otherwise(F.trim(F.regexp_replace(F.lower(text(name)), "[^a-z0-9]+", "_"), F.lit("_")))


def detect_script(c: Column) -> Column:
    """ru or fa if over three tenths of the letters are in that script, else en; empty under 20 letters."""
    count = lambda letters: F.regexp_count(text(c), F.lit(letters))
    cyrillic, arabic, latin = count("[а-яёА-ЯЁ]"), count(r"[\u0600-\u06FF]"), count("[a-zA-Z]")
    total = cyrillic + arabic + latin
    return F.when(total < 20, "").when(cyrillic / total > 0.3, "ru").when(arabic / total > 0.3, "fa").otherwise("en")


def resolve_language(declared: Column, c: Column) -> Column:
    return F.when(text(declared).isin("", "multi"), detect_script(c)).otherwise(declared)


def title_words(title: Column) -> Column:
    """Lower-case words of three letters or more, without dashes and quotes at their ends."""
    found = F.regexp_extract_all(F.lower(text(title)), F.lit(r"(?U)[^\W\d_][\w'-]{2,}"), F.lit(0))
    return F.transform(found, lambda w: F.regexp_replace(w, "^['-]+|['-]+$", ""))


def significant_words(c: Column) -> Column:
    """Distinct lower-case runs of four letters or more."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text(c)), F.lit(r"(?U)[^\W\d_]{4,}"), F.lit(0)))


def distinctive_words(c: Column, n: int = 2) -> Column:
    """The n longest significant words, alphabetical among equals."""
    by_length = F.transform(significant_words(c), lambda w: F.struct((-F.length(w)).alias("l"), w.alias("w")))
    return F.transform(F.slice(F.array_sort(by_length), 1, n), lambda x: x["w"])


def cut_to_word(c: Column) -> Column:
    """What follows the first space; empty if there is none."""
    at = F.instr(text(c), " ")
    return F.when(at > 0, F.substring(text(c), at + 1, F.length(text(c)))).otherwise("")


def escape_html(c: Column) -> Column:
    out = text(c)
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(raw), F.lit(safe))
    return out


def thousands(c: Column) -> Column:
    """A whole number with a space between thousands."""
    return F.replace(F.format_number(c, 0), F.lit(","), F.lit(" "))


def prompt(parts: list[tuple[str, Column, int]]) -> Column:
    """Lines `label: text`, each text cut to its number of characters; empty ones are left out."""
    return F.concat_ws("\n", *(F.when(collapse(c) != "", F.concat(F.lit(f"{label}: "), F.substring(collapse(c), 1, n))) for label, c, n in parts))


def judge_prompt(title: Column, source: Column, summary: Column, body: Column) -> Column:
    """The user's message to the judge: the whole title, the source, and JUDGE_CHARS of the summary or else the body."""
    strip = lambda c: F.regexp_replace(text(c), r"(?U)^\s+|\s+$", "")
    long = F.coalesce(F.nullif(strip(summary), F.lit("")), strip(body))
    line = lambda label, c: F.when(c != "", F.concat(F.lit(label), c))
    return F.concat_ws("\n", F.concat(F.lit("Titre : "), strip(title)), line("Source : ", strip(source)), line("Texte : ", left(long, JUDGE_CHARS)))


def looks_like_refusal(c: Column, phrases: list[str]) -> Column:
    return F.exists(F.array(*map(F.lit, phrases)), lambda p: F.contains(F.lower(text(c)), p))
