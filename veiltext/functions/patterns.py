"""Detector rules of the nine structured identifiers, as Java regular expressions.

The rules are written for ASCII word characters and ECMAScript white space:
Java's own ``\\b`` follows Unicode words and its ``\\s`` knows ASCII blanks
only, so both are spelled out.  Each expression is linear in the text and runs
in constant stack depth, however long the text.
"""

# --- fixed values -----------------------------------------------------------
# Labels, in the order that breaks ties between spans of equal start and end.
LABELS = (
    "EMAIL",
    "PHONE",
    "SSN",
    "CREDIT_CARD",
    "SECRET",
    "TOKEN",
    "IP_ADDRESS",
    "DATE",
    "ZIP_CODE",
)

# White space, as the inside of a character class.
SPACE = r"\t\n\x0B\f\r \x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}"

WORD_START = r"(?<![A-Za-z0-9_])"
WORD_END = r"(?![A-Za-z0-9_])"

# A look-ahead for the possible first characters leads each digit rule: it
# fails faster than the look-behind and does not change what matches.
PHONE = (
    r"(?=[0-9(+])(?<![A-Za-z0-9])"
    rf"(?:(?:\+?1[-.{SPACE}]?)?(?:\([0-9]{{3}}\)|[0-9]{{3}})[-.{SPACE}]?[0-9]{{3}}[-.{SPACE}]?[0-9]{{4}}"
    rf"|\+[0-9]{{1,3}}[-.{SPACE}]?[0-9]{{1,4}}(?:[-.{SPACE}]?[0-9]{{2,4}}){{2,3}})"
    r"(?![-A-Za-z0-9])"
)
SSN = (
    r"(?=[0-9])(?<![0-9])(?!000|666)[0-9]{3}"
    r"(?:-(?!00)[0-9]{2}-(?!0000)[0-9]{4}|(?!00)[0-9]{2}(?!0000)[0-9]{4})(?![0-9])"
)
CREDIT_CARD = (
    rf"(?=[345]){WORD_START}"
    r"(?:4[0-9]{12}(?:[0-9]{3})?|5[1-5][0-9]{14}|3[47][0-9]{13}"
    rf"|(?:4[0-9]{{3}}|5[1-5][0-9]{{2}}|3[47][0-9]{{2}})[-{SPACE}]?[0-9]{{4}}[-{SPACE}]?[0-9]{{4}}[-{SPACE}]?[0-9]{{4}}"
    rf"|3[47][0-9]{{2}}[-{SPACE}]?[0-9]{{6}}[-{SPACE}]?[0-9]{{5}}){WORD_END}"
)
SECRET = (
    rf"(?i)(?=[scap]){WORD_START}"
    r"(?:secret|client[_-]?secret|app[_-]?secret|password|passwd|pwd|private[_-]?key)"
    rf"[{SPACE}]*[:=][{SPACE}]*[\"']?[A-Za-z0-9._~+/=\-]{{8,}}[\"']?"
)
TOKEN = (
    rf"(?i)(?=[tar]){WORD_START}"
    r"(?:token|access[_-]?token|refresh[_-]?token|api[_-]?key|authorization)"
    rf"[{SPACE}]*[:=][{SPACE}]*[\"']?(?:Bearer[{SPACE}]+)?[A-Za-z0-9._~+/=\-]{{8,}}[\"']?"
)
OCTET = r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
IP_ADDRESS = rf"(?=[0-9]){WORD_START}{OCTET}\.{OCTET}\.{OCTET}\.{OCTET}{WORD_END}"
MONTH = (
    r"(?:Jan(?:uary)?|Feb(?:ruary)?|Mar(?:ch)?|Apr(?:il)?|May|Jun(?:e)?|Jul(?:y)?|Aug(?:ust)?"
    r"|Sep(?:t(?:ember)?)?|Oct(?:ober)?|Nov(?:ember)?|Dec(?:ember)?)"
)
DATE = (
    rf"(?i)(?=[0-9jfmasond]){WORD_START}"
    r"(?:(?:0?[1-9]|1[0-2])[/-](?:0?[1-9]|[12][0-9]|3[01])[/-](?:[0-9]{2}|[0-9]{4})"
    r"|[0-9]{4}-(?:0?[1-9]|1[0-2])-(?:0?[1-9]|[12][0-9]|3[01])"
    rf"|{MONTH}[{SPACE}]+(?:0?[1-9]|[12][0-9]|3[01]),[{SPACE}]+(?:19|20)[0-9]{{2}}){WORD_END}"
)
ZIP_CODE = rf"(?=[0-9]){WORD_START}[0-9]{{5}}(?:-[0-9]{{4}})?{WORD_END}"

# An e-mail address in parts: the detector works outward from each "@".
EMAIL_LOCAL = r"A-Za-z0-9!#$%&'*+\-/=?^_`{|}~."  # inside of a class
EMAIL_LOCAL_START = (
    r"(?<![A-Za-z0-9._%+\-@])(?![A-Za-z_]{2,20}=)[A-Za-z0-9!#$%&*+\-/=^_`{|}~]"
)
# Labels with one or two dots between them (one before the first allowed), then
# a dot and two or more letters.  Equal to (?:\.?[A-Za-z0-9-]+\.)+[A-Za-z]{2,},
# but Java repeats this form without recursion.
EMAIL_DOMAIN = (
    r"\A(?!\.\.)(?:(?!\.\.\.)[A-Za-z0-9.-])*[A-Za-z0-9-]\.[A-Za-z]{2,}(?![A-Za-z])"
)
# --- end of fixed values ----------------------------------------------------

RULES = {
    "PHONE": PHONE,
    "SSN": SSN,
    "CREDIT_CARD": CREDIT_CARD,
    "SECRET": SECRET,
    "TOKEN": TOKEN,
    "IP_ADDRESS": IP_ADDRESS,
    "DATE": DATE,
    "ZIP_CODE": ZIP_CODE,
}
