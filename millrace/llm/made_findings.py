"""Labelled findings for the forest of the secret scan, made from a seed.

Each finding is a line of text and, for a secret, the value in it. Secrets are random; what they are
told from looks like them but is a digest, an identifier, a path, code, a placeholder or prose.
"""

from __future__ import annotations

import random
import string
from collections.abc import Sequence

SEED = 42
HEX, UPPER, MIXED = "0123456789abcdef", string.ascii_uppercase + string.digits, string.ascii_letters + string.digits
WORDS = """
    account address amount animal article author banana building camera capital chapter city client color corner country
    customer daily default dinner document dragon energy example family figure filter flower garden general history holiday
    house hunter image index island keynote kitchen language letter library line market master member message model money
    mountain music name network number office orange order output package page paper partner people picture planet player
    price primary process product project record region report river school season secondary section series server service
    silver simple station status storage street student subject summer system table teacher theory ticket travel turkey
    update user value version village volume water weather window winter writer yellow
""".split()
STRONG_NAMES = """
    token secret password passwd pwd passphrase api_key API_KEY apiKey access_token ACCESS_TOKEN auth_token secretKey
    client_secret SECRET_KEY db_password DB_PASSWORD private_key credential authToken
""".split()
PASSWORD_NAMES = "password passwd pwd db_password PASSWORD passphrase".split()
PARAMETERS = "token api_key access_token secret".split()
DIGEST_NAMES = "sha256 sha1 md5 commit checksum digest etag hash revision integrity uuid guid id request-id trace_id build".split()


class Maker:
    """Random values and lines around them."""

    def __init__(self, words: Sequence[str], seed: int = SEED):
        self.random = random.Random(seed)
        self.words = [*WORDS, *words]

    def of(self, letters: str, least: int, most: int | None = None) -> str:
        return "".join(self.random.choices(letters, k=self.random.randint(least, most or least)))

    def word(self) -> str:
        return self.random.choice(self.words)

    def pick(self, *choices):
        return self.random.choice(choices)

    def key(self) -> str:
        """A random key: letters and digits mixed."""
        made = self.pick(
            lambda: self.of(HEX, *self.pick((32, 32), (40, 40), (64, 64), (16, 48))),
            lambda: self.of(MIXED, 16, 44),
            lambda: self.of(MIXED + "-_", 20, 50),
            lambda: self.of(MIXED + "+/", 24, 60) + self.pick("", "=", "=="),
            lambda: "".join(self.of(string.ascii_lowercase, 4) + self.of(string.digits, 4) for _ in range(self.random.randint(2, 5))),
        )()
        return made if any(c.isdigit() for c in made) and any(c.isalpha() for c in made) else self.key()

    def password(self) -> str:
        word = self.word()
        swapped = word.translate(str.maketrans("aeio", "4310")) if self.random.random() < 0.5 else word
        return self.pick(
            f"{swapped.capitalize()}{self.pick('&', '!', '#', '@', '$')}{self.of(string.digits, 1, 3)}",
            f"{word}{self.of(string.digits, 1, 2)}{self.of(string.ascii_letters, 1, 3)}",
            f"{swapped}{self.pick('!', '.', '*', '%')}{self.of(MIXED, 3, 6)}",
            self.of(MIXED + "!#%&*", 8, 14),
        )

    def known(self) -> str:
        """A key with its issuer's prefix."""
        letters = self.pick(MIXED, MIXED, HEX + "ABCDEF")
        return self.pick(
            lambda: self.pick("AKIA", "ASIA") + self.of(UPPER, 16),
            lambda: self.pick("ghp_", "gho_", "ghs_") + self.of(letters, 36),
            lambda: "sk-" + self.of(letters, 24, 48),
            lambda: self.pick("sk_live_", "rk_live_") + self.of(letters, 24),
            lambda: "xoxb-" + self.of(string.digits, 10) + "-" + self.of(MIXED, 24),
            lambda: "AIza" + self.of(MIXED + "-_", 35),
            lambda: "glpat-" + self.of(letters + "-_", 20),
            lambda: "eyJ" + self.of(MIXED, 20, 40) + ".eyJ" + self.of(MIXED, 30, 80) + "." + self.of(MIXED + "-_", 43),
        )()

    def pem(self) -> str:
        kind = self.pick("", "RSA ", "EC ", "OPENSSH ")
        body = "\n".join(self.of(MIXED + "+/", 64) for _ in range(self.random.randint(2, 20)))
        end = f"\n-----END {kind}PRIVATE KEY-----" if self.random.random() < 0.7 else ""
        return f"-----BEGIN {kind}PRIVATE KEY-----\n{body}{end}"

    def assigned(self, value: str, name: str) -> str:
        quote = self.pick("", "", '"', "'", "`")
        joint = self.pick("=", " = ", ": ", ":", " := ", " => ")
        field = self.pick(name, name, f'"{name}"', f"'{name}'")
        return f"{field}{joint}{quote}{value}{quote}"

    def secret(self) -> tuple[str, str]:
        """A line and the secret in it."""
        key, name, password, known, pem = self.key(), self.pick(*STRONG_NAMES), self.password(), self.known(), self.pem()
        plain = key.rstrip("=").replace("/", "x").replace("+", "y")
        return self.pick(
            lambda: (self.assigned(key, name), key),
            lambda: (self.assigned(key, name), key),
            lambda: (self.assigned(password, self.pick(*PASSWORD_NAMES)), password),
            lambda: (f"https://{self.word()}.org/{self.word()}?{self.pick(*PARAMETERS)}={plain}", plain),
            lambda: (f"Authorization: {self.pick('Bearer', 'Basic', 'bearer')} {key}", key),
            lambda: (self.pick(known, f"{self.word()} {known}", self.assigned(known, self.pick("key", "id", name))), known),
            lambda: (self.pick(known, f"{self.word()} {known}", f"{self.word()}: {known}"), known),
            lambda: (f"{self.word()}\n{pem}", pem),
        )()

    def lookalike(self) -> str:
        """A line without a secret."""
        word = self.word
        number = lambda least=1, most=5: self.of(string.digits, least, most)
        uuid = "-".join(self.of(HEX, n) for n in (8, 4, 4, 4, 12))
        digest = self.of(HEX, self.pick(32, 40, 64))
        plain = self.pick("key", "api", "auth", "token", "password", "secret", "API_KEY")
        return self.pick(
            lambda: f"{self.pick(*DIGEST_NAMES)}{self.pick(':', ': ', ' ', '=', ' = ')}{digest}",
            lambda: f"{self.pick(*DIGEST_NAMES)}{self.pick(':', ': ', ' ', '=')}{uuid}",
            lambda: self.pick(digest, uuid, f"{word()} {digest}", f"{word()} {uuid}"),
            lambda: f"data:{self.pick('image/png', 'image/jpeg', 'font/woff')};base64,{self.of(MIXED + '+/', 40, 400)}==",
            lambda: f"/{word()}/{word()}/{word()}-{word()}{number()}.{self.pick('txt', 'py', 'html')}",
            lambda: f"https://{word()}.example.com/{word()}/{word()}-{number()}/{word()}",
            lambda: f"{self.pick('key', 'primary key', 'auth', 'foreign key', 'key')}{self.pick(': ', '=', ' = ')}{word()}_{word()}_{number()}",
            lambda: f"{self.pick('key', 'auth', 'Key')}{self.pick(': ', '=', ' = ')}{word()}{number()}",
            lambda: f"{self.pick('Basic', 'basic', 'Bearer', 'bearer')} {word()}{number(0, 3)}",
            lambda: f"{self.pick('a', 'the')} {self.pick('basic', 'bearer')} {word()} {word()}",
            lambda: f"{plain} = {word()}_{word()}{number(0, 2)}({self.pick('x', word(), '')})",
            lambda: f"{plain} = {word()}.{word()}[{word()}]",
            lambda: f"{plain}{self.pick('', 's')} = {self.pick('[', '(', '{')}{number()}, {self.pick(number(), word())}",
            lambda: f"{plain}{self.pick('', 's')}: {self.pick('[', '{')}{self.pick(word(), number())}: {word()}",
            lambda: f"{plain}: {self.pick('${', '{{', '<', '%')}{word().upper()}_{word().upper()}{self.pick('}', '}}', '>', '%')}",
            lambda: f"{plain}: https://{word()}.org/{word()}/{word()}",
            lambda: f"{plain}: {self.pick('', 'a ', 'the ')}{word()}",
            lambda: f"{plain} = {self.pick('None', 'null', 'true', 'false', 'undefined', '********', 'xxxxxxxx', 'changeme', 'required')}",
            lambda: f"{plain}: YOUR_{word().upper()}_HERE",
            lambda: f"{plain}: 20{number(2, 2)}-0{number(1, 1)}-1{number(1, 1)}T0{number(1, 1)}:00:00",
            lambda: f"{word()}_{word()}_{word()}_{number()}",
            lambda: f"{word()}{word().capitalize()}{word().capitalize()}{word().capitalize()}",
            lambda: "-".join(word() for _ in range(self.random.randint(3, 6))),
            lambda: f"{word().upper()}-{number(4, 4)}-{word().upper()}-{number(5, 8)}",
            lambda: self.of(string.digits, 16, 24),
            lambda: self.pick("-", "_", "=", "a", "x", "/") * self.random.randint(16, 60),
            lambda: f"{word()}/{word()}/{word()}/{word()}",
            lambda: f"{word()}{word()}{word()}{word()}",
        )()


def labelled_lines(count: int, words: Sequence[str] = ()) -> list[tuple[str, str | None]]:
    """``count`` lines, half of them with the secret they hold, half with None."""
    maker = Maker(words)
    rows: list[tuple[str, str | None]] = []
    for number in range(count):
        line, value = maker.secret() if number % 2 else (maker.lookalike(), None)
        before, after = (" ".join(maker.word() for _ in range(maker.random.randint(0, 4))) for _ in range(2))
        gap = maker.pick("\n", " ", ", ") if after else maker.pick("", "\n", " ")
        rows.append((" ".join(part for part in (before, line) if part) + gap + after, value))
    return rows
