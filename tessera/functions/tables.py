"""Letters, legal forms, scripts and corruption tables.

They must be these for right results.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

# Latin spelling of letters.
CYRILLIC = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ё": "e", "ж": "zh", "з": "z", "и": "i", "й": "y",
    "к": "k", "л": "l", "м": "m", "н": "n", "о": "o", "п": "p", "р": "r", "с": "s", "т": "t", "у": "u", "ф": "f",
    "х": "h", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "sh", "ъ": "", "ы": "y", "ь": "", "э": "e", "ю": "yu", "я": "ya",
}
CYRILLIC_MORE = {
    "ә": "a", "ғ": "g", "қ": "k", "ң": "n", "ө": "o", "ұ": "u", "ү": "u", "һ": "h", "і": "i", "ї": "i", "ў": "u",
    "ҳ": "h", "ҷ": "j", "ҹ": "j", "ҫ": "s", "ҙ": "z", "ҡ": "k", "ҥ": "n", "ӑ": "a", "ӓ": "a", "ӗ": "e", "ӝ": "zh",
    "ӟ": "z", "ӥ": "i", "ӧ": "o", "ӱ": "u", "ӳ": "u", "ӹ": "y", "ѓ": "g", "ѕ": "z", "ј": "y", "љ": "l", "њ": "n",
    "ћ": "ch", "ќ": "k", "џ": "j", "ҽ": "ch", "ӕ": "ae",
}
ARMENIAN = {
    "ա": "a", "բ": "b", "գ": "g", "դ": "d", "ե": "e", "զ": "z", "է": "e", "ը": "y", "թ": "t", "ժ": "zh", "ի": "i",
    "լ": "l", "խ": "kh", "ծ": "ts", "կ": "k", "հ": "h", "ձ": "dz", "ղ": "gh", "ճ": "ch", "մ": "m", "յ": "y", "ն": "n",
    "շ": "sh", "ո": "o", "չ": "ch", "պ": "p", "ջ": "j", "ռ": "r", "ս": "s", "վ": "v", "տ": "t", "ր": "r", "ց": "ts",
    "ւ": "v", "փ": "p", "ք": "k", "օ": "o", "ֆ": "f", "և": "ev",
}
LATIN = {
    "ə": "a", "ı": "i", "ğ": "g", "ş": "sh", "ç": "ch", "ö": "o", "ü": "u", "İ": "i", "â": "a", "ê": "e", "î": "i",
    "ô": "o", "û": "u", "ñ": "n", "á": "a", "é": "e", "í": "i", "ó": "o", "ú": "u", "ý": "y", "ä": "a",
}

# Words of a company's legal form.
LEGAL_FORMS = {
    "llc": ["ооо", "тоо", "жшс", "чп", "пк", "llc", "ltd", "limited", "ooo", "too", "co", "company", "хх", "ххк", "mchj", "mchc", "мчж", "սպը", "спэ", "mmc", "ммс"],
    "jsc": ["ао", "оао", "зао", "акционерное", "ак", "jsc", "sa", "aş", "as", "asc", "qsc", "бнхаа", "хк", "բաց", "փբը", "пбэ"],
    "ie": ["индивидуальный", "предприниматель", "жеке", "ie", "ип"],
    "gov": ["министерство", "агентство", "департамент", "ministry", "agency", "department", "яам"],
    "ngo": ["фонд", "ассоциация", "союз", "foundation", "association", "union", "нөхөрлөл", "ohf"],
}

# Letter ranges of scripts, as regular expression classes.
SCRIPTS = {
    "latin": "A-Za-z\\u00C0-\\u024F",
    "cyrillic": "\\u0400-\\u04FF\\u0500-\\u052F",
    "armenian": "\\u0530-\\u058F",
    "georgian": "\\u10A0-\\u10FF",
    "arabic": "\\u0600-\\u06FF",
}
PROFILE_SCRIPTS = SCRIPTS | {"cjk": "\\u4E00-\\u9FFF"}
MORE_CYRILLIC_LETTERS = "[\\u0450-\\u052F\\u04D0-\\u04FF]"

# Corruption of names.
OTHER_SPELLINGS = {
    "zh": ["j", "g", "z"], "kh": ["h", "x", "k"], "ts": ["c", "tz"], "ch": ["c", "tch"], "sh": ["s", "sch"],
    "yu": ["iu", "ju", "u"], "ya": ["ia", "ja", "a"], "y": ["i", "j"], "i": ["y"], "ov": ["ow", "off", "of"],
    "ev": ["ew", "eff", "ef"], "ks": ["x"], "g": ["gh"], "k": ["q", "c"], "u": ["oo", "ou"], "e": ["ye"],
}
FOLDED = {
    "ә": "а", "ғ": "г", "қ": "к", "ң": "н", "ө": "о", "ұ": "у", "ү": "у", "һ": "х", "і": "и", "ў": "у", "ҳ": "х",
    "ҷ": "ч", "ə": "a", "ı": "i", "ğ": "g", "ş": "s", "ç": "c", "ö": "o", "ü": "u",
}
NEIGHBOUR_KEYS = {
    "а": "фвыпр", "б": "юьди", "в": "чсмуа", "г": "нршо", "д": "жлбщ", "е": "нкупр", "и": "мтьбю", "к": "епаув",
    "л": "дощж", "м": "сивчя", "н": "гершо", "о": "лрщтг", "п": "аривк", "р": "поенг", "с": "чвмыа", "т": "иьбющ",
    "у": "цвкае", "ы": "фсчвз", "a": "qwsz", "e": "wrsd", "i": "uojk", "o": "ipkl", "n": "bhjm", "r": "etdf",
    "s": "adwx", "t": "ryfg", "l": "kop", "k": "jlio", "v": "cbfg", "m": "n,jk",
}
EQUAL_FORMS = [
    ["ооо", "ооо", "общество с ограниченной ответственностью", "llc", "ltd"],
    ["тоо", "жшс", "too", "llc"],
    ["ххк", "хк", "llc"],
    ["ао", "акционерное общество", "jsc"],
]
CORRUPTION_WEIGHTS = {
    "to_latin_variant": 3, "alt_translit": 2, "fold_diacritics": 3, "swap_tokens": 2, "drop_token": 2, "abbreviate": 1,
    "typo": 2, "swap_legal_form": 1,
}

LETTERS = CYRILLIC | CYRILLIC_MORE | ARMENIAN | LATIN


@lru_cache
def single_letters() -> tuple[str, str]:
    """Arguments of translate(): letters spelled by one or no Latin letter.

    Beside the tables these are, by rule, all letters whose base without diacritics is one
    ASCII character, and the combining marks, which go.
    """
    one, none = {}, []
    for point in range(0x80, sys.maxunicode + 1):
        ch = chr(point)
        if ch in LETTERS or 0xD800 <= point < 0xE000:
            continue
        if unicodedata.combining(ch):
            none.append(ch)
        elif unicodedata.decomposition(ch):
            base = "".join(c for c in unicodedata.normalize("NFD", ch) if not unicodedata.combining(c))
            if len(base) == 1 and base.isascii():
                one[ch] = base
            elif not base:
                none.append(ch)
    for ch, spelled in LETTERS.items():
        if len(spelled) == 1:
            one[ch] = spelled
        elif not spelled:
            none.append(ch)
    return "".join([*one, *none]), "".join(one.values())
