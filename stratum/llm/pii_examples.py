"""A small labelled table for the personal-data tagger, made from patterns and short word lists.

Each row is a line of words with a tag for each: ``name``, ``address``, ``birth``, ``account``, ``contact`` or ``O``. The
lists hold everyday words, and words of random letters stand beside them, so the tagger has to go by shapes and by the
words around. Lines without personal data are prose of random syllables, with numbers, amounts, dates, versions and
capitals in places where a careless tagger sees some.
"""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

LABELS = ("O", "name", "address", "birth", "account", "contact")

GIVEN = "Anna Ben Carla David Elena Felix Grace Hugo Ines Jonas Karim Laura Marco Nora Omar Paula Rosa Simon Tara Yusuf".split()
FAMILY = "Smith Garcia Weber Martin Rossi Novak Silva Dubois Larsen Kaya Schmidt Lopez Moreau Brown Jones Peeters".split()
TOWNS = "London Berlin Madrid Paris Lyon Hamburg Sevilla Leeds Boston Austin Denver Bremen".split()
STREETS = ("{w} Street", "{w} Road", "{w} Avenue", "{w} Lane", "{w}straße", "Calle {w}", "rue {w}", "Avenida {w}", "{w}weg")
MONTHS = "January March May July October December enero Mai mars".split()
SYLLABLES = "an the er on in ti re ed es or ha ou st nd at en th ion ly que la ment eau ción ado heit ung chen ver".split()

#: Frequent words of four languages, for the prose.
FREQUENT = ("the of and to in is was for that with by from this it be as are on a not at or an which you have had but we "
            "de la el que los las en un una del por con para se no y su es al lo le les des est une dans pour sur avec et il "
            "die der das und ist von mit für auf ein eine den im zu nicht sich dem auch wie über").split()

#: Cues come before what they announce; {n}, {a}, {b}, {k} and {c} are the tagged parts.
PATTERNS = (
    "my name is {n}", "My name is {n} and", "Dear {n} ,", "Mr {n}", "Mrs. {n} said", "Dr. {n}", "Ms {n} was", "Name: {n}",
    "signed by {n}", "regards , {n}", "Mein Name ist {n}", "Herr {n}", "Frau {n}", "je m'appelle {n}", "Monsieur {n}",
    "Madame {n}", "me llamo {n}", "Señor {n}", "Señora {n}", "nombre: {n}", "nom: {n}", "patient {n} ,",
    "I live at {a}", "Address: {a}", "address is {a} ,", "ships to {a}", "wohnt in {a}", "Adresse: {a}", "vivo en {a}",
    "dirección: {a}", "j'habite {a}", "adresse: {a}",
    "born on {b}", "date of birth: {b}", "DOB: {b}", "DOB {b}", "geboren am {b}", "nacido el {b}", "né le {b}", "birthday {b}",
    "SSN {k}", "SSN: {k}", "passport no. {k}", "passport number {k}", "account number {k}", "IBAN {k}", "IBAN: {k}",
    "national id {k}", "driver license {k}", "Kontonummer {k}", "DNI {k}", "tax id: {k}",
    "call me at {c}", "phone: {c}", "tel. {c}", "Telefon: {c}", "teléfono {c}", "reach me at {c}", "mail me at {c}",
    "email: {c}", "e-mail {c}", "mobile {c}", "fax {c}", "contact: {c}",
    "my name is {n} , born on {b} ,", "Name: {n} Address: {a}", "{n} , phone: {c}", "Mr {n} , SSN {k}",
)


def digits(rng: random.Random, n: int) -> str:
    return "".join(rng.choice("0123456789") for _ in range(n))


def letters(rng: random.Random) -> str:
    return "".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4)))


def person(rng: random.Random) -> list[str]:
    given = rng.choice(GIVEN) if rng.random() < 0.5 else letters(rng).capitalize()
    family = rng.choice(FAMILY) if rng.random() < 0.5 else letters(rng).capitalize()
    return [given, family] if rng.random() < 0.7 else [family]


def address(rng: random.Random) -> list[str]:
    street = rng.choice(STREETS).format(w=letters(rng).capitalize()).split()
    number = digits(rng, rng.randint(1, 3))
    place = [number, *street] if rng.random() < 0.6 else [*street, number]
    if rng.random() < 0.5:
        place[-1] += ","
        place += rng.choice(([digits(rng, 5), rng.choice(TOWNS)], [rng.choice(TOWNS), digits(rng, 5)], [rng.choice(TOWNS)]))
    return place


def birth(rng: random.Random) -> list[str]:
    day, month, year = str(rng.randint(1, 28)), str(rng.randint(1, 12)), str(rng.randint(1930, 2015))
    if rng.random() < 0.6:
        month = month.zfill(2)
    return rng.choice(([f"{day}/{month}/{year}"], [f"{year}-{month}-{day:0>2}"], [f"{day}.{month}.{year}"],
                       [day, rng.choice(MONTHS), year], [rng.choice(MONTHS), day + ",", year]))


def account(rng: random.Random) -> list[str]:
    return rng.choice((
        [f"{digits(rng, 3)}-{digits(rng, 2)}-{digits(rng, 4)}"], [rng.choice("CXPK") + digits(rng, 8)], [digits(rng, 8) + "Z"],
        ["DE" + digits(rng, 20)], ["ES" + digits(rng, 2), *(digits(rng, 4) for _ in range(5))], [digits(rng, rng.randint(8, 12))]))


def contact(rng: random.Random) -> list[str]:
    who, host = letters(rng), letters(rng)
    return rng.choice((
        [f"{digits(rng, 3)}-{digits(rng, 3)}-{digits(rng, 4)}"], [f"({digits(rng, 3)})", f"{digits(rng, 3)}-{digits(rng, 4)}"],
        ["0" + digits(rng, 3), digits(rng, 6)], [f"0{digits(rng, 3)}/{digits(rng, 6)}"], [f"{who}[at]{host}[dot]org"],
        [f"{who}(at){host}(dot)org"], [f"{who}[at]{host}.com"], [f"{who}(at){host}.net"]))


SLOTS = {"{n}": ("name", person), "{a}": ("address", address), "{b}": ("birth", birth), "{k}": ("account", account),
         "{c}": ("contact", contact)}


def prose(rng: random.Random, n: int) -> list[str]:
    words: list[str] = []
    for i in range(n):
        word = letters(rng) if rng.random() < 0.65 else rng.choice(FREQUENT)
        if rng.random() < 0.15 or i == 0:
            word = word.capitalize()
        if rng.random() < 0.04:
            word = rng.choice((digits(rng, rng.randint(1, 6)), digits(rng, 16), "$" + digits(rng, 3), digits(rng, 2) + "%",
                               f"{digits(rng, 1)}.{digits(rng, 1)}", str(rng.randint(1900, 2030)),
                               f"v{digits(rng, 1)}.{digits(rng, 2)}", ".".join(digits(rng, 2) for _ in range(4)),
                               f"{letters(rng)}.{digits(rng, 2)}@mail.example.com", "|", "***", "%%",
                               '"' + "".join(rng.choice("0123456789abcdef") for _ in range(40)) + '"', "AKIA" + digits(rng, 8)))
        if rng.random() < 0.01:
            words += ["+1", f"({digits(rng, 3)})", f"{digits(rng, 3)}-{digits(rng, 4)}"]
        if rng.random() < 0.15:
            word += rng.choice((".", ",", "!!", "***", ":"))
        words += [word] * (rng.randint(3, 20) if rng.random() < 0.01 else 1)
    style = rng.random()
    return [w.upper() for w in words] if style < 0.04 else [w.capitalize() for w in words] if style < 0.08 else words


def line(rng: random.Random) -> tuple[list[str], list[str]]:
    words: list[str] = []
    tags: list[str] = []

    def add(more: list[str], tag: str = "O") -> None:
        words.extend(more)
        tags.extend([tag] * len(more))

    add(prose(rng, rng.randint(0, 8)))
    if rng.random() < 0.4:
        for part in rng.choice(PATTERNS).split():
            tag, made = SLOTS.get(part, ("O", lambda _, part=part: [part]))
            add(made(rng), tag)
        add(prose(rng, rng.randint(0, 6)))
    else:
        add(prose(rng, rng.randint(4, 30)))
    return words, tags


def made(n: int, seed: int = 11) -> list[tuple[int, list[str], list[str]]]:
    rng = random.Random(seed)
    return [(i, *line(rng)) for i in range(n)]


def examples(spark: SparkSession, n: int = 1800, seed: int = 11) -> DataFrame:
    """(line_id, words, tags), the same on every call."""
    return spark.createDataFrame(made(n, seed), "line_id long, words array<string>, tags array<string>")
