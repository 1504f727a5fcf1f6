import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pagemill.llm import personal

FAMILY = {p + e for p in ("Ash", "Birken", "Quill", "Tarn", "Osk") for e in ("brandt", "wick", "holt", "mont")} - {"Quillholt", "Tarnwick"}
NAMES = personal.Names({"Emil", "Rose", "Grace", "Kenji", "Inés"}, FAMILY)


def found(text):
    return [(k, text[a:b]) for k, a, b in personal.mentions(text, NAMES)]


@pytest.mark.parametrize(
    ("text", "mention"),
    [
        ("write to emil.x_4+a@mail.example.org.", "emil.x_4+a@mail.example.org"),
        ("EMIL@POST.EXAMPLE now", "EMIL@POST.EXAMPLE"),
        ("at a.b (at) post dot example dot org.", "a.b (at) post dot example dot org"),
        ("go to x[at]red.invalid, please", "x[at]red.invalid"),
        ("me at x_1 @\ngilde-nord.example with", "x_1 @\ngilde-nord.example"),
        ("it is jo at mail dot example now", "jo at mail dot example"),
        ("ｅmil@pоst.example", "ｅmil@pоst.example"),
    ],
)
def test_email(text, mention):
    assert found(text) == [("email", mention)]


@pytest.mark.parametrize("address", ["jo ( at ) mail.example", "jo <at> mail.example", "jo [ät] mail.example", "jo (chez) mail.example", "jo at host punkt de", "jo at mail point fr", "jo at one dot com", "jo arroba mail point lugar"])
def test_every_disguise_counts_by_itself(address):
    assert found(f"please write to {address}, thanks") == [("email", address)]
    assert found("Look at this point in time. They came at the dot on the map, held at knife point by two.") == []


@pytest.mark.parametrize("number", ["312-555-0177", "312‑555‑0177", "(030) 23125 461", "0049/30/23125214", "+44 20 7946 0319", "020 7946 0016", "+1 202 555 0101", "415.555.0192", "202 555 0129 ext. 6", "030 23125-884", "+33 1 99 00 94 97", "16175550120", "555-0137"])
def test_phone(number):
    assert found(f"please call {number} during office hours") == [("phone", number)]


def test_id_in_capitals():
    assert found("HER SHEET STILL SHOWED SSN 000-14-1531 NEXT TO THE SCORE") == [("id", "000-14-1531")]
    assert found("INSURANCE NUMBER QQ 30 13 93 D WHEN CLAIMING") == [("id", "QQ 30 13 93 D")]


def test_spelled_phone():
    assert found("Call five five five, zero one three seven today") == [("phone", "five five five, zero one three seven")]


@pytest.mark.parametrize(("lead", "number"), [("SSN: ", "000-14-1531"), ("social security number ", "000-94-7071"), ("insurance number ", "QQ 30 13 93 D"), ("passport # ", "Z62685168"), ("national ID ", "900000/6935"), ("driver licence ", "GFH 6059 220"), ("tax ID ", "00-5800471"), ("wurde Ausweisnummer ", "L67X37931"), ("Personalausweis-Nr. ", "L06X62012")])
def test_id(lead, number):
    assert found(f"Her sheet showed {lead}{number} next to the score.") == [("id", number)]


@pytest.mark.parametrize(
    "place",
    ["PO Box 1705, Port Ansel 40023", "124B Beacon Avenue, Apt 23, Brackwater, 65606", "Station Road 91, Fernhollow", "171 Tallow St., Tillingham Cross 74046", "Flat 5, 122 Millrace Lane, Greywick", "Birkenallee 72, 66149 Steinhagenau", "Am Alten Markt 12, 66149 Neuwinkel", "203 Station Road\nBrackwater 76163", "Gerbergasse 225, 42043 Bad\nMoorbach", "12 rue de la Paix, 75002 Lyon", "Calle Mayor 5, 28013 Madrid"],
)
def test_address(place):
    assert found(f"goes by post to {place}; late ones don't") == [("address", place)]


@pytest.mark.parametrize("place", ["12 BEACON AVENUE, BRACKWATER 40023", "PO BOX 1705, PORT ANSEL 40023", "STATION ROAD 91, FERNHOLLOW", "12 RUE DE LA PAIX, 75002 LYON", "AN DER MÜHLE 5, 66149 BAD MOORBACH", "HAUPTSTRAßE 5, 66149 NEUWINKEL"])
def test_address_in_capitals_anywhere(place):
    plain = "The stag walks over the hill and comes to rest. " * 50
    for before, after in (("", "; late ones don't"), (plain + "It goes to ", "; late ones don't"), (plain + "SEND IT TO ", " BEFORE THE NEXT TURN"), ("THE STAG WALKS. " * 200 + "SEND IT TO ", " BY FRIDAY. " + plain)):
        assert found(before + place + after) == [("address", place)]
    assert found(plain + "ROLL 20 ON THE HILL, THEN REST; THE 3 OF THE OLD QUAY, AND LEVEL 3") == []


@pytest.mark.parametrize("name", ["Emil Ashbrandt", "Emil S. Quillholt", "ROSE TARNWICK", "Ashwick, Kenji", "Zelda Birkenmont", "Inés Oskholt-Tarnbrandt", "Kenji\nQuillmont"])
def test_name(name):
    assert found(f"we ask for {name} before the next turn") == [("name", name)]


@pytest.mark.parametrize(
    "text",
    [
        "The chase runs down Beacon Avenue, past Old Quay 7 times, and ends.",
        "See ISBN 978-0-0000-2614-0 for it. Printed 2021-04-170, file v22.2.11.21, map grid 1513-14022.",
        "Product code RB-30027-77 replaces it; sold on Tallow Street in the crypt for 21-4-18 marks.",
        "The handle @Emeric posts a toad. Stat line 29/10/15, guard 4, vigor 120-45, speed 30.",
        "Garrod the Elder met Hessa of the Nine Keys. Rose petals cost 555 sp. Grace the dancer waits.",
        "Hugo's stag and Petra's ladder are listed under 21 029 55. Roll d100: 01-05 a hag, 06-40 nothing.",
        "Herr Ashbrandt came at dot.",
        "Bonus by level: +12 13–15 +14\n16–20 +18 01–05 7",
        "",
    ],
)
def test_nothing(text):
    assert found(text) == []


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aEmil AshbrandtＡ​@.‑5- \nfive(at)dot", max_size=80))
def test_spans_are_in_order_and_within(text):
    spans = personal.mentions(text, NAMES)
    assert all(0 <= a < b <= len(text) for _, a, b in spans)
    clean = personal.redact(text, spans)
    kept = "".join(text[x:y] for x, y in zip([0, *(b for _, _, b in spans)], [*(a for _, a, _ in spans), len(text)], strict=True) if x < y)
    for k in personal.KINDS:
        clean = clean.replace(f"[{k.upper()}]", "")
    assert len(clean) <= len(text) and (not spans or len(kept) < len(text))


def test_frame(spark):
    text = "Ｃall 312-555-0177\nor write to a@b.example.\n\nEmil Ashbrandt"
    docs = spark.createDataFrame([(1, text, "mine"), (1, text, "mine"), (2, None, None), (3, "", None), (4, "word " * 60_000 + "a@b.example", None)], "doc_id bigint, text string, mentions string")
    known = spark.createDataFrame([("Emil", "given"), ("Ashbrandt", "family"), (None, "given"), ("X", None), ("Emil", "given")], "name string, kind string")
    got = personal.find_personal(docs, known).collect()
    first = [r for r in got if r.doc_id == 1]
    assert len(first) == 2 and first[0].mentions_input == "mine"
    assert [(m.kind, m.line_no) for m in first[0].mentions] == [("phone", 1), ("email", 2), ("name", 4)]
    assert first[0].redacted == "Ｃall [PHONE]\nor write to [EMAIL].\n\n[NAME]"
    by = {r.doc_id: r for r in got}
    assert by[2].mentions is None and by[2].redacted is None and by[3].mentions == [] and by[3].redacted == ""
    assert by[4].redacted.endswith("word [EMAIL]")
    assert personal.find_personal(docs.limit(0), known.limit(0)).count() == 0
    with pytest.raises(ValueError):
        personal.find_personal(docs, known, max_names=2)


def test_whole_mentions_or_none():
    assert found("ask j o h n at example dot com today") == [("email", "j o h n at example dot com")]
    assert found("pay to IBAN DE89 3704 0044 0532 0130 00 by Friday, or by card 4000 1234 5678 9010 at once") == []
    assert found("He phoned five five five one two one two and left") == [("phone", "five five five one two one two")]


def test_letters_taken_apart():
    for name in ("Inés Ashbrandt", "Emil Oskho​lt"):
        assert found(f"we ask for {name} before the next turn") == [("name", name)]


def test_many_mentions_take_time_in_proportion():
    import time

    def took(n):
        text = "write to a@b.example or call 312-555-0177 now. " * n
        began = time.process_time()
        assert len(found(text)) == 2 * n
        return time.process_time() - began

    took(500)
    assert took(8000) < 40 * max(took(500), 0.005)
