"""Overwriting personal data with generated values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed order: mail addresses and long digit runs go first, since a card number
# would also pass for a phone number. Of the two number forms an unbroken run comes
# first, since the grouped form would stop inside a longer run. Patterns use only syntax common to Java and RE2.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "number": r"[0-9]{12,}|[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{1,7}",
    "ip": r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}",
    "phone": r"(\+[0-9]{1,3}[ .-]?)?(\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}",
}
# Every number, IP address and phone number holds one of these.
DIGITS_NEEDED = r"[0-9]{3}|[0-9]\.[0-9]"


def surrogate(kind: str, key: Column, seed: int) -> Column:
    """A made-up value that depends only on seed, record key and kind.

    Digits are the hexadecimal ones of a digest, shifted into 0..9 by ``translate``.
    """
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string"), F.lit(kind)))
    digits = F.translate(digest, "abcdef", "012345")
    return {
        "email": F.concat(F.lit("user_"), F.substring(digest, 1, 8), F.lit("@example.com")),
        "number": F.concat(F.lit("#"), F.substring(digits, 1, 8)),
        "ip": F.concat(F.lit("192.0.2."), F.substring(digits, 1, 1)),
        "phone": F.concat(F.lit("555-01"), F.substring(digits, 1, 2)),
    }[kind]


def scrub_pii(text: Column, key: Column, seed: int = 42) -> Column:
    """Overwrite mail addresses, long numbers, IP addresses and phone numbers.

    Texts without what every match must hold skip the patterns. Names and street
    addresses have no pattern; they need a model's labels.
    """
    original = text
    for kind, pattern in PATTERNS.items():
        replaced = F.regexp_replace(text, F.lit(pattern), surrogate(kind, key, seed))
        needed = F.contains(original, F.lit("@")) if kind == "email" else F.regexp_like(original, F.lit(DIGITS_NEEDED))
        text = F.when(needed, replaced).otherwise(text)
    return text


def _known_digest(kind: Column, value: Column, key: str) -> Column:
    return F.sha2(F.concat_ws(":", F.lit(key), kind, value), 256)


def value_surrogate(value: Column, key: str) -> Column:
    """A made-up value of the same kind that depends only on the key and the value found.

    Mail addresses are compared in lower case, numbers by their digits. 48 and more bits of a keyed digest keep
    different values apart; without the key nobody can tell which value a surrogate stands for.
    """
    email = F.contains(value, F.lit("@"))
    ip = F.regexp_like(value, F.lit(f"^({PATTERNS['ip']})$"))
    number = F.regexp_like(value, F.lit(f"^({PATTERNS['number']})$"))
    kind = F.when(email, "email").when(number, "number").when(ip, "ip").otherwise("phone")
    plain = F.when(email, F.lower(value)).when(ip, value).otherwise(F.regexp_replace(value, "[^0-9]", ""))
    digest = _known_digest(kind, plain, key)
    letters, digits = F.translate(digest, "0123456789", "ghijklmnop"), F.translate(digest, "abcdef", "012345")
    return (
        F.when(email, F.concat(F.lit("user_"), F.substring(letters, 1, 12), F.lit("@example.com")))
        .when(number, F.concat(F.lit("#"), F.substring(digits, 1, 16)))
        .when(ip, F.concat(F.lit("2001:db8::"), F.substring(digest, 1, 4), F.lit(":"), F.substring(digest, 5, 4), F.lit(":"), F.substring(digest, 9, 4)))
        .otherwise(F.concat(F.lit("555-"), F.substring(digits, 1, 16))))


def scrub_values(text: Column, key: str) -> Column:
    """Overwrite mail addresses, long numbers, IP addresses and phone numbers, each value by its own surrogate.

    Equal values get equal surrogates in all texts, different values different ones, so texts can still be
    joined on them. The text is cut once into matches of any pattern, the leftmost first, and the gaps between them, which
    alternate; what has been put in is not searched again.
    """
    every = F.lit("|".join(f"(?:{p})" for p in PATTERNS.values()))
    matches, gaps = F.regexp_extract_all(text, every, F.lit(0)), F.split(text, "|".join(f"(?:{p})" for p in PATTERNS.values()), -1)
    changed = F.zip_with(gaps, matches, lambda gap, found: F.concat(gap, F.when(found.isNull(), "").otherwise(value_surrogate(found, key))))
    needed = F.contains(text, F.lit("@")) | F.regexp_like(text, F.lit(DIGITS_NEEDED))
    return F.when(needed, F.array_join(changed, "")).otherwise(text)
