"""A small labelled table of sentences with personal data, for fitting the sequence model.

Sentences are made from templates and fillers by a fixed rule. ``{email}``, ``{phone}``, ``{ip}`` and
``{card}`` stand for spans of that kind; ``{number}`` stands for numbers that are nobody's.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TEMPLATES = (
    "Write to {email} for details.",
    "My address is {email} and it works.",
    "contact: {email}",
    "Reach me at {email}, any day",
    "Mail {email} or call {phone} today.",
    "Schreib an {email} bitte.",
    "Meine Adresse ist {email}.",
    "Mon adresse est {email}, merci.",
    "Mi correo es {email} gracias",
    "the of and {email} is was on",
    "Call {phone} after six.",
    "phone {phone}",
    "call {phone} please",
    "{phone} is mine",
    "{email} is mine.",
    "{ip} is up",
    "{card} is mine",
    "Tel. {phone} or fax",
    "my number is {phone}, ring me",
    "Ruf {phone} an.",
    "Appelez le {phone} demain",
    "Llama al {phone} ahora",
    "the and of {phone} that is in",
    "The server {ip} is down.",
    "login from {ip} at noon",
    "ip {ip}",
    "host {ip} answered",
    "in the {ip} and of",
    "Pay with {card} please.",
    "card {card}",
    "card number {card} valid",
    "Karte {card} bitte",
    "tarjeta {card} por favor",
    "the of {card} and is",
    "Order {number} has shipped.",
    "page {number} of the book",
    "version {number} is out",
    "on {number} we met",
    "it cost {number} euros",
    "the {number} of and in",
    "we saw the {number} at the dot com boom",
    "meet at noon and look at the map",
    "look at the dot on the map",
    "We met at noon. Then it rained.",
    "they look at him. She left at once.",
    "it was at home.and in the of",
    "ce n'est point la fin (at) all",
    "un point de vue, le point est clair",
    "the list ( . ) ends at last . Next one",
    "token = {number} was in the log",
    "{number} and {number} are numbers",
    "a.b | c.d | {number} | e.f",
    "On {number}, at {number}, the train left.",
    "license {number} section {number}",
)

#: Spans written so that plain patterns miss them, and some that they find.
FILLERS = {
    "email": (
        "jo.miller at mail dot example dot org",
        "ann (at) example (dot) com",
        "kim [at] post [dot] example [dot] net",
        "li{at}example{dot}org",
        "max.weber AT example DOT de",
        "eva @ example . com",
        "tom @ mail.example.org",
        "lou(at)example.com",
        "sam [at] example.net",
        "ida at example dot com",
        "rene arobase exemple point fr",
        "luz arroba ejemplo punto es",
        "paul <at> example <dot> com",
        "jan.55@mail3.example.com",
        "mia_7 at web dot example dot com",
        "bob dot smith at gmail dot com", "john (at) corp (dot) example (dot) org",
        "ben [dot] hall [at] work [dot] example [dot] co", "zoe at uni-ulm dot de",
        "nina(dot)berg(at)firma(dot)example(dot)de", "ole punkt falk at dorf punkt example punkt de",
        "info(@)example.org", "jill.ray at example.com", "joan ( at ) example.org", "dora [ at ] web.example.net",
        "marc at domaine point fr", "gus at example (.) org", "pat at mail.example.com", "luc.petit at web ( . ) exemple ( . ) fr",
        "rosa < at > correo punto es", "bob AT gmail DOT com", "ANN DOT LEE AT MAIL DOT ORG", "Kim At Post Dot Example Dot Net",
        "max AT example DOT org", "constantin.maximilian.von.hohenfeld-weissenburg at verwaltung dot example dot com",
        "ab.cd.ef.gh.ij.kl.mn.op.qr.st.uv at example dot com",
    ),
    "phone": (
        "(017) 555-7713", "974-555-3436", "974.555.3436", "(487) 555 7209", "555-0136-22",
        "0049 30 1234567", "030/1234567-8", "01 23 45 67 89", "912 345 678", "+49 (30) 555-1234",
        "+1 (243) 555-5526", "0171 - 555 12 34", "(020) 7946 0958", "00 33 1 23 45 67 89",
        "555 . 123 . 4567", "1-800-555-0199",
    ),
    "ip": (
        "97.51.17.173", "10 . 0 . 0 . 7", "192[.]168[.]1[.]20", "172(.)16(.)0(.)1", "8 dot 8 dot 4 dot 4",
        "203[dot]0[dot]113[dot]9", "198 .51 .100 .23", "127[.]0[.]0[.]1",
        "10 dot 20 dot 30 dot 40", "192 DOT 168 DOT 0 DOT 10", "172 punkt 16 punkt 0 punkt 9", "203 dot 0 dot 113 dot 77",
        "100 dot 64 dot 7 dot 250",
    ),
    "card": (
        "4012 8888 8888 1881", "4012888888881881", "5555.5555.5555.4444", "4111/1111/1111/1111",
        "4111  1111  1111  1111", "6011 - 1111 - 1111 - 1117", "5105_1051_0510_5100", "4222.2222.2222.2220",
    ),
    "number": (
        "12345678", "2024-01-31", "31.01.2024", "1.2.3", "3,456.78", "1,000,000", "12:30", "42",
        "9b0b3c6a43eb78aa99cbd7049c572391524f37a8", "4.0", "978-3-16", "1999", "A-4711/22", "17%", "$99.95",
        "9807915762804490", "0001234567890123", "10/11/12", "2.0", "0x7f3a", "20240131T101500", "555",
        "4845168114407329", "1/2", "100.5.2", "2019-2023",
    ),
}

_SLOT = re.compile(r"\{(email|phone|ip|card|number)\}")


def sentences() -> list[tuple[str, list[tuple[str, int, int]]]]:
    """Texts and their spans (kind, start, end)."""
    rows = []
    for i, template in enumerate(TEMPLATES):
        slots = _SLOT.findall(template)
        rounds = max((len(FILLERS[s]) for s in slots), default=1)
        for turn in range(rounds):
            text, spans, at = "", [], 0
            for k, m in enumerate(_SLOT.finditer(template)):
                text += template[at : m.start()]
                kind, choices = m.group(1), FILLERS[m.group(1)]
                value = choices[(turn + i + 5 * k) % len(choices)]
                if kind != "number":
                    spans.append((kind, len(text), len(text) + len(value)))
                text += value
                at = m.end()
            rows.append((text + template[at:], spans))
    return rows


def examples(spark: SparkSession) -> DataFrame:
    """The labelled table: ``text, spans``, spans as ``kind:start:end`` joined by commas."""
    rows = [(t, ",".join(f"{k}:{a}:{b}" for k, a, b in s)) for t, s in sentences()]
    return spark.createDataFrame(rows, "text string, spans string")
