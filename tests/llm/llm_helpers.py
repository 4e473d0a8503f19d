"""What the tests of this folder share."""

import zlib

WORDS = "the cat sat on a mat and saw nine small birds fly over old stone walls near deep blue water".split()


def crc(key, by):
    return zlib.crc32(str(key).encode()) % by


def words_of(text):
    """Words between ASCII white space, spelled out for the brute-force versions."""
    out, word = [], ""
    for c in (text or "") + " ":
        if c in "\x20\x09\x0a\x0b\x0c\x0d":
            out += [word] if word else []
            word = ""
        else:
            word += c
    return out


def ascii_lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
