"""Text expressions. All stay in the JVM: no Python function sees a row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as an emoji and as a user handle. The classes also
# hold the plain characters "+" and "|", which are therefore removed too.
EMOJI = r"[\p{So}+|\x{FE0F}]"
HANDLE = r"@[\w|_]+"

# A letter or decimal digit of the basic plane: a letter outside of it (written
# as two UTF-16 units) does not make a token a word.
WORD_CHARACTER = r"[\p{L}\p{Nd}&&[^\x{10000}-\x{10FFFF}]]"
DIGITS_ONLY = r"\A[\p{Nd}&&[^\x{10000}-\x{10FFFF}]]*\z"

SENTENCE_END = r"[.!?]+\s*|\n+"


def strip_emoji(text: Column) -> Column:
    return F.regexp_replace(text, EMOJI, "")


def strip_handles(text: Column) -> Column:
    return F.regexp_replace(text, HANDLE, "")


def clean(text: Column) -> Column:
    """Emoji go first, so a "|" between a handle and a word is gone before handles are."""
    return strip_handles(strip_emoji(text))


def word_tokens(text: Column) -> Column:
    """Split at single spaces and keep the tokens that hold a letter or digit.

    Only the space separates: a line break stays inside its token.
    """
    return F.filter(F.split(text, " "), lambda token: token.rlike(WORD_CHARACTER))


def tokens(text: Column) -> Column:
    """Word tokens of a text without its handles (emoji are left in)."""
    return word_tokens(strip_handles(text))


def sentences(text: Column) -> Column:
    """Split after runs of ``.!?`` and at line breaks; empty pieces are dropped."""
    return F.filter(F.split(text, SENTENCE_END), lambda sentence: sentence != "")


# Words whose full stop ends no sentence, in lower case.
ABBREVIATIONS = ("approx.", "co.", "dr.", "etc.", "inc.", "jr.", "ltd.", "mr.", "mrs.", "ms.", "no.", "prof.", "sr.", "st.", "vs.")
# Letters with a full stop each, such as "U.S." and "e.g.", maybe behind an opening quote.
INITIALS = r"^[\"'(\[]*(\p{L}\.)+[,;:]?$"
# A sentence ends with these, maybe before closing quotes; dots in a row only where a capital letter follows.
END_MARKS = r"[.!?\x{2026}]+[\"')\]\x{00BB}\x{201D}\x{2019}]*$"
ELLIPSIS = r"(\.\.+|\x{2026})[\"')\]\x{00BB}\x{201D}\x{2019}]*$"
CAPITAL = r"^[\"'(\[\x{00AB}\x{201C}\x{2018}]*\p{Lu}"
# No text should hold this character, which marks the ends of sentences on the way; one that does loses it.
MARK = "\x01"


def sentences_by_rules(text: Column) -> Column:
    """Split at the ends of sentences: one pass over the words of each line, each with the next one in view.

    A word ends a sentence if it ends in ``.``, ``!`` or ``?``, maybe before closing
    quotes. Numbers such as 3.5 have their stop inside; abbreviations and initials
    (``e.g.``, ``U.S.``) end none; dots in a row end one only before a capital letter. Line
    breaks end sentences as well. Sentences are words joined by one space.
    """
    lines = F.split(F.translate(text, MARK, ""), r"\n+")

    def marked(line: Column) -> Column:
        words = F.filter(F.split(line, r"[ \t\r\x0B\f]+"), lambda word: word != "")
        # The only entry of an array, so that the words are made once and not once a word.
        return F.transform(F.array(words), _with_ends)[0]

    def _with_ends(words: Column) -> Column:
        def mark(word: Column, at: Column) -> Column:
            following = F.coalesce(F.get(words, at + 1), F.lit(""))
            stops = word.rlike(END_MARKS) & ~F.lower(word).isin(*ABBREVIATIONS) & ~word.rlike(INITIALS)
            stops = stops & (~word.rlike(ELLIPSIS) | following.rlike(CAPITAL))
            return F.when(stops, F.concat(word, F.lit(MARK))).otherwise(word)

        return F.array_join(F.transform(words, mark), " ")

    whole = F.array_join(F.transform(lines, marked), MARK)
    return F.filter(F.transform(F.split(whole, MARK), lambda part: F.trim(part)), lambda sentence: sentence != "")


def non_empty(text: Column) -> Column:
    return text.isNotNull() & (text != "")


def valid_id(post_id: Column) -> Column:
    """True for ids of digits only. The empty id passes; NULL does not."""
    return F.coalesce(post_id.rlike(DIGITS_ONLY), F.lit(False))


def unquote(value: Column) -> Column:
    return F.replace(value, F.lit('"'), F.lit(""))
