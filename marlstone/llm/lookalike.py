"""One consistent form for texts that look the same.

Characters of other widths, ligatures, letters of mathematical alphabets, blanks of other kinds, the non-breaking
hyphen and characters without width are folded one by one, accents are composed.
Look-alike letters can't be: Cyrillic 'о' is right in one word and a disguise in
another. Each letter therefore has the set of scripts in which some letter looks like
it (for letters without a double, their Script_Extensions), and a token resolves to the intersection of its letters' sets:

    Latin is in it        the token is spelled in Latin; this covers words wholly of
                          look-alikes, which no reader could tell from Latin ones
    other scripts only    it is spelled in the first of them, in the order of SCRIPTS
    empty                 the scripts are truly mixed; each look-alike goes to Latin

The sets, and so the spelling, depend only on how letters look, which makes
the form the same for all texts that look alike. Case, missing accents, raised and
other digits and the number of blanks stay as they are, and so do the joiners and tags inside
emoji sequences, which make one picture of several.
"""

from __future__ import annotations

import re
import unicodedata

import regex

#: In order of preference; a set of scripts is a number with one bit for each.
SCRIPTS = ("Latin", "Cyrillic", "Greek", "Armenian", "Cherokee", "Lisu", "Coptic")
LATIN, EVERY = 1, (1 << len(SCRIPTS)) - 1

# A Latin letter and the letters that look like it, of whichever script.
LOOKALIKES = (
    "AАΑᎪꓮ", "BВΒᏴꓐⲂ", "CСϹᏟꓚⲤ", "DᎠꓓ", "EЕΕᎬꓰ", "FꓝϜ", "GᏀꓖԌ", "HНΗᎻꓧⲎ", "IІΙꓲⲒ", "JЈͿᎫꓙ", "KКΚᏦꓗⲔ", "LᏞꓡ", "MМΜᎷꓟⲘ", "NΝꓠⲚ", "OОΟՕꓳⲞ", "PРΡᏢꓑⲢ", "QԚ", "RᎡꓣ", "SЅՏᏚꓢ", "TТΤᎢꓔⲦ", "UՍꓴ", "VѴᏙꓦ", "WԜᎳꓪ", "XХΧꓫⲬ", "YҮΥꓬⲨ", "ZΖᏃꓜ",
    "aаαɑ", "cсϲⲥ", "dԁ", "eе", "gցɡ", "hһհᏂ", "iіιıᎥ", "jјϳȷ", "kκ", "lӏ", "nոՈ", "oоοօⲟ", "pрρⲣ", "qԛզ", "sѕ", "tτ", "uυս", "vѵν", "wԝա", "xхⲭ", "yуγ",
)

# Ranges of characters without width.
NO_WIDTH = (
    (0xAD, 0xAD), (0x34F, 0x34F), (0x61C, 0x61C), (0x180B, 0x180F), (0x200B, 0x200F), (0x202A, 0x202E), (0x2060, 0x206F), (0xFE00, 0xFE0F), (0xFEFF, 0xFEFF), (0x1BCA0, 0x1BCA3), (0x1D173, 0x1D17A),
    (0xE0001, 0xE0001), (0xE0020, 0xE007F), (0xE0100, 0xE01EF),
)

BLOCKS = "\u0370-\u058f\u13a0-\u13ff\u1c80-\u1c8f\u1f00-\u1fff\u2c80-\u2cff\u2de0-\u2dff\ua4d0-\ua4ff\ua640-\ua69f\uab70-\uabbf"
JOINER, FLAG = "\u200d", "\U0001f3f4"
#: Where joiners and tags of emoji sequences stay while the rest is folded.
ASIDE = 0x10F000


def folds() -> dict[int, str | None]:
    """By rule, over the two planes that hold such characters: compatibility forms of width and ligatures, mathematical letters, blanks, hyphens."""
    table: dict[int, str | None] = {}
    for cp in range(0x80, 0x20000):
        c = chr(cp)
        tag = unicodedata.decomposition(c).partition(">")[0]
        if tag in ("<wide", "<narrow") or 0xFB00 <= cp <= 0xFB06 or 0xFB13 <= cp <= 0xFB17:
            table[cp] = unicodedata.normalize("NFKC", c)
        elif tag == "<font" and unicodedata.category(c)[0] == "L":
            table[cp] = unicodedata.normalize("NFKC", c)
        if unicodedata.category(c) in ("Zs", "Zl", "Zp"):
            table[cp] = " "
    table[0x2010] = table[0x2011] = "-"
    table[0xB5] = "\u03bc"
    for lo, hi in NO_WIDTH:
        table.update(dict.fromkeys(range(lo, hi + 1)))
    return table


class Normaliser:
    """form(text) is equal for texts that look alike."""

    def __init__(self):
        self._ready = False

    def __getstate__(self):
        return {"_ready": False}

    def _prepare(self) -> None:
        self._fold = folds()
        # a class within the basic plane is tested by table, one beyond it item by item
        low, high = ("".join(re.escape(chr(c)) for c in self._fold if (c > 0xFFFF) == far) for far in (False, True))
        self._folded, self._folded_far = re.compile(f"[{low}]+").sub, re.compile(f"[{high}]+").sub
        self._scx = [regex.compile(rf"\p{{scx={name}}}").match for name in SCRIPTS]
        self._common = regex.compile(r"\p{scx=Zyyy}|\p{scx=Zinh}").match
        self._sets: dict[str, int] = {}
        self._own: dict[str, int] = {}
        self._spell: list[dict[str, str]] = [{} for _ in SCRIPTS]
        for row in LOOKALIKES:
            mask, first = 0, {}
            for c in row:
                own = self._scripts(c)
                mask |= own
                for i in range(len(SCRIPTS)):
                    if own >> i & 1:
                        first.setdefault(i, c)
            for c in row:
                self._sets[c] = mask
                for i, to in first.items():
                    self._spell[i][c] = to
        # look-alikes, and the blocks of the scripts that have them; plain Latin is spelled as it is
        odd = "".join(c for row in LOOKALIKES for c in row[1:])
        self._other = re.compile(f"[{odd}{BLOCKS}]").search
        self._token = regex.compile(r"[\p{L}\p{M}]+")
        self._sequence = regex.compile(rf"(?<=\p{{Extended_Pictographic}}[\ufe0f\U0001f3fb-\U0001f3ff]?){JOINER}(?=\p{{Extended_Pictographic}})|(?<={FLAG})[\U000e0020-\U000e007e]+\U000e007f").sub
        self._memo: dict[str, str] = {}
        self._ready = True

    def _scripts(self, c: str) -> int:
        """The scripts that c is used in; all for common characters, none for those of other scripts."""
        mask = self._own.get(c)
        if mask is None:
            mask = sum(1 << i for i, match in enumerate(self._scx) if match(c))
            if not mask and self._common(c):
                mask = EVERY
            self._own[c] = mask
        return mask

    def _resolved(self, base: str) -> int:
        out = EVERY
        for c in base:
            if not unicodedata.combining(c):
                alike = self._sets.get(c)
                out &= self._scripts(c) if alike is None else alike
        return out

    def spelling(self, token: str) -> str:
        """token (letters and marks) in its consistent script."""
        if not self._ready:
            self._prepare()
        known = self._memo.get(token)
        if known is not None:
            return known
        base = unicodedata.normalize("NFD", token)
        resolved = self._resolved(base)
        to = self._spell[(resolved & -resolved).bit_length() - 1 if resolved else 0]
        out = unicodedata.normalize("NFC", "".join(to.get(c, c) for c in base))
        if len(token) <= 64:
            if len(self._memo) > 1 << 17:
                self._memo.clear()
            self._memo[token] = out
        return out

    def _plain(self, text: str) -> str:
        """Folded and composed, letters as they are."""
        aside = JOINER in text or FLAG in text
        if aside:
            text = self._sequence(lambda m: "".join(chr(ASIDE + (ord(c) & 0xFFF)) for c in m[0]), text)
        text = self._folded(lambda m: m[0].translate(self._fold), text)
        if max(text, default="") > "\uffff":
            text = self._folded_far(lambda m: m[0].translate(self._fold), text)
        text = unicodedata.normalize("NFC", text)
        if aside:
            text = "".join(chr((0xE0000 if (o := ord(c) - ASIDE) != 0xD else 0x2000) + o) if ord(c) >= ASIDE and ord(c) < ASIDE + 0x1000 else c for c in text)
        return text

    def form(self, text: str) -> str:
        if text.isascii():
            return text
        if not self._ready:
            self._prepare()
        text = self._plain(text)
        # tokens of Latin letters, or of scripts without look-alikes, are spelled as they are
        return self._token.sub(lambda m: m[0] if m[0].isascii() else self.spelling(m[0]), text) if self._other(text) else text

    def kind(self, token: str) -> str:
        """mixed: its letters of SCRIPTS share none of these; other scripts beside them, as in Japanese, are no disguise.
        whole: not Latin, but all letters look Latin. Else single."""
        if not self._ready:
            self._prepare()
        base = unicodedata.normalize("NFD", token)
        own = EVERY
        for c in base:
            if not unicodedata.combining(c):
                own &= self._scripts(c) or EVERY
        if not own:
            return "mixed"
        return "single" if own & LATIN or not self._resolved(base) & LATIN else "whole"

    def kinds(self, text: str) -> tuple[int, int]:
        """How many tokens of a text are mixed, and wholly confusable."""
        if text.isascii():
            return 0, 0
        if not self._ready:
            self._prepare()
        text = self._plain(text)
        if not self._other(text):
            return 0, 0
        found = [self.kind(t) for t in self._token.findall(text) if not t.isascii()]
        return found.count("mixed"), found.count("whole")
