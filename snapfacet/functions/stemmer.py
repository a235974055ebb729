"""The English stemmer of the Snowball project ("Porter 2"), as a small per-word helper.

Written from the published definition of the algorithm (M. F. Porter and R. Boulton, "The English
(Porter2) stemming algorithm", snowballstem.org). Used only through the Arrow-batched UDF in
``text_index``, over the distinct vocabulary of an index.
"""

from __future__ import annotations

import re
from functools import lru_cache

# Fixed values of the published definition.
_VOWEL = "aeiouy"
_DOUBLE = ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")
_LI = "cdeghkmnrt"
_EXCEPTIONS = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl",
    "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl", "sky": "sky", "news": "news", "howe": "howe",
    "atlas": "atlas", "cosmos": "cosmos", "bias": "bias", "andes": "andes",
}
_AFTER_1A = {"inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed"}
_R1_PREFIX = ("gener", "commun", "arsen")
_STEP2 = {
    "tional": "tion", "enci": "ence", "anci": "ance", "abli": "able", "entli": "ent", "izer": "ize", "ization": "ize",
    "ational": "ate", "ation": "ate", "ator": "ate", "alism": "al", "aliti": "al", "alli": "al", "fulness": "ful",
    "ousli": "ous", "ousness": "ous", "iveness": "ive", "iviti": "ive", "biliti": "ble", "bli": "ble", "fulli": "ful",
    "lessli": "less",
}
_STEP3 = {"tional": "tion", "ational": "ate", "alize": "al", "icate": "ic", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
_STEP4 = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ism", "ate", "iti", "ous", "ive", "ize")


def _regions(w: str) -> tuple[int, int]:
    """Where R1 and R2 begin: after the first non-vowel that follows a vowel, twice."""

    def after(start: int) -> int:
        m = re.search(f"[{_VOWEL}][^{_VOWEL}]", w[start:])
        return start + m.end() if m else len(w)

    r1 = next((len(p) for p in _R1_PREFIX if w.startswith(p)), None)
    r1 = after(0) if r1 is None else r1
    return r1, after(r1)


def _short_end(w: str) -> bool:
    """Ends in a short syllable."""
    if len(w) == 2:
        return w[0] in _VOWEL and w[1] not in _VOWEL
    return len(w) > 2 and w[-3] not in _VOWEL and w[-2] in _VOWEL and w[-1] not in _VOWEL + "wxY"


def _longest(w: str, suffixes) -> str | None:
    return max((s for s in suffixes if w.endswith(s)), key=len, default=None)


@lru_cache(maxsize=200_000)
def stem(word: str) -> str:
    if len(word) <= 2:
        return word
    if word in _EXCEPTIONS:
        return _EXCEPTIONS[word]
    w = word.lstrip("'")
    w = re.sub(f"^y|(?<=[{_VOWEL}])y", "Y", w)
    r1, r2 = _regions(w)
    # 0: possessives
    end = _longest(w, ("'s'", "'s", "'"))
    w = w[: len(w) - len(end)] if end else w
    # 1a: plurals
    end = _longest(w, ("sses", "ied", "ies", "us", "ss", "s"))
    if end == "sses":
        w = w[:-2]
    elif end in ("ied", "ies"):
        w = w[:-2] if len(w) > 4 else w[:-1]
    elif end == "s" and re.search(f"[{_VOWEL}]", w[:-2]):
        w = w[:-1]
    if w in _AFTER_1A:
        return w
    # 1b: past and participle
    end = _longest(w, ("eedly", "eed", "ingly", "edly", "ing", "ed"))
    if end in ("eed", "eedly"):
        if len(w) - len(end) >= r1:
            w = w[: len(w) - len(end)] + "ee"
    elif end and re.search(f"[{_VOWEL}]", w[: len(w) - len(end)]):
        w = w[: len(w) - len(end)]
        if w.endswith(("at", "bl", "iz")):
            w += "e"
        elif w.endswith(_DOUBLE):
            w = w[:-1]
        elif _short_end(w) and len(w) <= r1:
            w += "e"
    # 1c: final y
    if len(w) > 2 and w[-1] in "yY" and w[-2] not in _VOWEL:
        w = w[:-1] + "i"
    # 2 and 3: compound suffixes in R1
    end = _longest(w, (*_STEP2, "ogi", "li"))
    if end and len(w) - len(end) >= r1:
        body = w[: len(w) - len(end)]
        if end in _STEP2:
            w = body + _STEP2[end]
        elif end == "ogi" and body.endswith("l"):
            w = body + "og"
        elif end == "li" and body and body[-1] in _LI:
            w = body
    end = _longest(w, (*_STEP3, "ative"))
    if end and len(w) - len(end) >= r1:
        if end in _STEP3:
            w = w[: len(w) - len(end)] + _STEP3[end]
        elif len(w) - len(end) >= r2:
            w = w[: len(w) - len(end)]
    # 4: suffixes in R2
    end = _longest(w, (*_STEP4, "ion"))
    if end and len(w) - len(end) >= r2:
        body = w[: len(w) - len(end)]
        if end != "ion" or body.endswith(("s", "t")):
            w = body
    # 5: final e and l
    if w.endswith("e"):
        if len(w) - 1 >= r2 or (len(w) - 1 >= r1 and not _short_end(w[:-1])):
            w = w[:-1]
    elif w.endswith("l") and len(w) - 1 >= r2 and w[-2:-1] == "l":
        w = w[:-1]
    return w.replace("Y", "y")
