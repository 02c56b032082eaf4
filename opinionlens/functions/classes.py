r"""Insides of character classes that every engine here reads alike.

``\x{...}`` is understood by Java and RE2, ``\p{...}`` too.
"""

# Every code point that Unicode calls white space, and the four separators U+001C..U+001F.
SPACE_CHARS = (
    r"\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
WORD_CHARS = r"\p{L}\p{N}_"
