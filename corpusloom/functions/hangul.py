"""Hangul syllables to letters and back, by code-point arithmetic on the Unicode block."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Compatibility letters in the order of the syllable block.
INITIALS = "ㄱㄲㄴㄷㄸㄹㅁㅂㅃㅅㅆㅇㅈㅉㅊㅋㅌㅍㅎ"
MEDIALS = "ㅏㅐㅑㅒㅓㅔㅕㅖㅗㅘㅙㅚㅛㅜㅝㅞㅟㅠㅡㅢㅣ"
FINALS = "-ㄱㄲㄳㄴㄵㄶㄷㄹㄺㄻㄼㄽㄾㄿㅀㅁㅂㅄㅅㅆㅇㅈㅊㅋㅌㅍㅎ"
FIRST_SYLLABLE = 0xAC00
LAST_SYLLABLE = 0xD7A3


def to_jamo(col: Column) -> Column:
    """Each syllable becomes three letters, a missing final being ``-``; spaces are squeezed.

    A lone consonant stands in the first place and a lone vowel in the second.
    """
    def letter(letters: str, index: Column) -> Column:
        return F.substring(F.lit(letters), index.cast("int") + 1, F.lit(1))

    def spell(char: Column) -> Column:
        code = F.ascii(char)
        offset = code - FIRST_SYLLABLE
        return (
            F.when(
                code.between(FIRST_SYLLABLE, LAST_SYLLABLE),
                F.concat(
                    letter(INITIALS, F.floor(offset / 588)),
                    letter(MEDIALS, F.floor(offset % 588 / 28)),
                    letter(FINALS, offset % 28),
                ),
            )
            .when(char.rlike("^[ㄱ-ㅎ]$"), F.concat(char, F.lit("--")))
            .when(char.rlike("^[ㅏ-ㅣ]$"), F.concat(F.lit("-"), char, F.lit("-")))
            .otherwise(char)
        )

    spelled = F.array_join(F.transform(F.split(col, ""), spell), "")
    hangul = F.when(col.rlike("[ㄱ-ㅣ가-힣]"), spelled).otherwise(col)
    return F.regexp_replace(hangul, r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{3000}]+", " ")


def from_jamo(col: Column) -> Column:
    """Inverse of ``to_jamo`` for full syllables; other characters stay."""
    def index(letters: str, char: Column) -> Column:
        return F.instr(F.lit(letters), char) - 1

    def compose(unit: Column) -> Column:
        code = (
            F.lit(FIRST_SYLLABLE)
            + index(INITIALS, F.substring(unit, 1, 1)) * 588
            + index(MEDIALS, F.substring(unit, 2, 1)) * 28
            + index(FINALS, F.substring(unit, 3, 1))
        )
        utf16 = F.unhex(F.lpad(F.hex(code), 4, "0"))
        return F.when(F.length(unit) == 3, F.decode(utf16, "UTF-16BE")).otherwise(unit)

    units = F.regexp_extract_all(col, F.lit("(?s)[ㄱ-ㅎ][ㅏ-ㅣ][ㄱ-ㅎ-]|."), F.lit(0))
    return F.when(col.rlike("[ㄱ-ㅎ][ㅏ-ㅣ]"), F.array_join(F.transform(units, compose), "")).otherwise(col)
