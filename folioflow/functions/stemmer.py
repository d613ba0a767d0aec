"""English stop words and Porter's stemmer (M. F. Porter, 1980)."""

from __future__ import annotations

#: Words that an English query ignores.
STOP_WORDS = frozenset(
    "a about above after again against all am an and any are as at be because been before being below between both but by can did do does doing don down during each few for from further had has have having he her here "
    "hers herself him himself his how i if in into is it its itself just me more most my myself no nor not now of off on once only or other our ours ourselves out over own s same she should so some such t than that the "
    "their theirs them themselves then there these they this those through to too under until up very was we were what when where which while who whom why will with you your yours yourself yourselves".split()
)
_STEP2 = (("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("abli", "able"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"))
_STEP3 = (("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", ""))
_STEP4 = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize")


def _consonants(w: str) -> list[bool]:
    out: list[bool] = []
    for i, c in enumerate(w):
        out.append(c not in "aeiou" and not (c == "y" and i > 0 and out[-1]))
    return out


def _measure(w: str) -> int:
    c = _consonants(w)
    return sum(1 for a, b in zip(c, c[1:], strict=False) if not a and b)


def _vowel(w: str) -> bool:
    return not all(_consonants(w))


def _cvc(w: str) -> bool:
    c = _consonants(w)
    return len(w) > 2 and c[-3:] == [True, False, True] and w[-1] not in "wxy"


def _swap(w: str, table) -> str:
    for end, new in sorted(table, key=lambda p: -len(p[0])):
        if w.endswith(end):
            base = w[: -len(end)]
            return base + new if _measure(base) > 0 else w
    return w


def stem(w: str) -> str:
    if len(w) < 3 or not w.isascii():
        return w
    if w.endswith("sses") or w.endswith("ies"):
        w = w[:-2]
    elif w.endswith("s") and not w.endswith("ss"):
        w = w[:-1]
    if w.endswith("eed"):
        w = w[:-1] if _measure(w[:-3]) > 0 else w
    else:
        base = next((w[: -len(e)] for e in ("ed", "ing") if w.endswith(e) and _vowel(w[: -len(e)])), None)
        if base is not None:
            double = len(base) > 1 and base[-1] == base[-2] and _consonants(base)[-1] and base[-1] not in "lsz"
            w = base + "e" if base.endswith(("at", "bl", "iz")) or (not double and _measure(base) == 1 and _cvc(base)) else base[:-1] if double else base
    if w.endswith("y") and _vowel(w[:-1]):
        w = w[:-1] + "i"
    w = _swap(_swap(w, _STEP2), _STEP3)
    for end in sorted(_STEP4, key=len, reverse=True):
        if w.endswith(end):
            base = w[: -len(end)]
            if _measure(base) > 1 and (end != "ion" or base.endswith(("s", "t"))):
                w = base
            break
    if w.endswith("e") and (_measure(w[:-1]) > 1 or (_measure(w[:-1]) == 1 and not _cvc(w[:-1]))):
        w = w[:-1]
    return w[:-1] if w.endswith("ll") and _measure(w) > 1 else w
