import random

import numpy as np
import pytest

from corpusloom.llm import furniture, language, pii

NAMES = pii.Names([("Mirela", "given"), ("Anselm", "given")] + [(s + e, "surname") for s in ("Kolb", "Varn", "Jarv", "Lind", "Orm", "Zarn") for e in ("aux", "etti", "mann", "berg", "ovic", "quist") if (s, e) != ("Zarn", "ovic")])


def kinds(t):
    return [(k, t[s:e]) for s, e, k in pii.find(t, NAMES)]


@pytest.mark.parametrize(
    "text,want",
    [
        ("Mail a.b+c@x.example now", [("email", "a.b+c@x.example")]),
        ("write to j_k [at] dept [dot] example [dot] com.", [("email", "j_k [at] dept [dot] example [dot] com")]),
        ("at jk AT dept DOT example before", [("email", "jk AT dept DOT example")]),
        ("Follow @handle for more", []),
        ("Call (212) 555 0118 and", [("phone", "(212) 555 0118")]),
        ("ring +44 (0)1632 960829.", [("phone", "+44 (0)1632 960829")]),
        ("Appelez le 02.61.91.73.94 et", [("phone", "02.61.91.73.94")]),
        ("The order number was 697-1595-18, printed", []),
        ("Part no. 9247-11-489 fits; covers 1978-1984 only; on 14/08/2014 it", []),
        ("Invoice 4111111111111111 lists", []),
        ("card: 4111-1111-1111-1111, holder", [("card", "4111-1111-1111-1111")]),
        ("My account is NL61 XBNK 0377 6862 52, in", [("iban", "NL61 XBNK 0377 6862 52")]),
        ("insurance number, QQ 44 42 33 C, was", [("national_id", "QQ 44 42 33 C")]),
        ("Su DNI es 00440389-E, según", [("national_id", "00440389-E")]),
        ("sécurité sociale: numéro de sécurité sociale est le 2 74 07 90 101 906 74. x", [("national_id", "2 74 07 90 101 906 74")]),
        ("to Flat 8, 102 Tarandale Rd, but", [("address", "Flat 8, 102 Tarandale Rd")]),
        ("at 1560 N. Galilu Ave., Apt 8B now", [("address", "1560 N. Galilu Ave., Apt 8B")]),
        ("habite 231 bis, avenue Galelsk depuis", [("address", "231 bis, avenue Galelsk")]),
        ("wohnt Zeleniastraße 194 im Hof", [("address", "Zeleniastraße 194")]),
        ("vive en C/ Elmummere, 211 ayer", [("address", "C/ Elmummere, 211")]),
        ("The Old Road was closed in 1980.", []),
        ("said Mirela Kolbaux today", [("person", "Mirela Kolbaux")]),
        ("by Lenora K. Zarnovic and", [("person", "Lenora K. Zarnovic")]),
        ("to VARNETTI, ANSELM for", [("person", "VARNETTI, ANSELM")]),
        ("Dr. A. Jarvmann signed", [("person", "A. Jarvmann")]),
        ("Frau Lindberg wohnt", [("person", "Lindberg")]),
        ("Anselm Ormovic-Kolbetti wrote", [("person", "Anselm Ormovic-Kolbetti")]),
        ("", []), (None, []), ("   ", []),
    ],
)
def test_find(text, want):
    assert kinds(text or "") == want and pii.find(None, NAMES) == []


@pytest.mark.parametrize(
    "text,want",
    [
        ("Mr. Okonkwo signed the form.", [("person", "Okonkwo")]),
        ("We met Thomas Fletcher and Priya Raghunathan there", [("person", "Thomas Fletcher"), ("person", "Priya Raghunathan")]),
        ("Dr. Jean-Luc Picard left", [("person", "Jean-Luc Picard")]),
        ("Frau Nowak wohnt hier", [("person", "Nowak")]),
        ("Contact Archive Home", []),
        ("SSN 123-45-6789 is hers", [("national_id", "123-45-6789")]),
        ("the account HU42 1177 3016 1111 1018 0000 0000 here", [("iban", "HU42 1177 3016 1111 1018 0000 0000")]),
        ("at 12 Elm Park Mews now", [("address", "12 Elm Park Mews")]),
        ("Mail José.Núñez@exámple.es now", [("email", "José.Núñez@exámple.es")]),
    ],
)
def test_find_without_the_lexicon(text, want):
    assert kinds(text) == want


def test_names_held_out_of_the_lexicon():
    """Surnames made of known parts, and any name after a title, need not be in the lexicon."""
    r = random.Random(3)
    begins, ends = ("Kolb", "Varn", "Jarv", "Lind", "Orm", "Zarn", "Hask", "Rind"), ("aux", "etti", "mann", "berg", "ovic", "quist", "dottir", "wright")
    every = [b + e for b in begins for e in ends]
    held = set(r.sample(every, 16))
    names = pii.Names([(x, "surname") for x in every if x not in held] + [("Mirela", "given")])
    found = sum(pii.find(f"The form was signed by Mirela {x} today.", names) == [(23, 30 + len(x), "person")] for x in held)
    assert found >= 0.9 * len(held)


def test_find_is_linear():
    import time

    def took(n):
        t = " ".join(f"at {i} Old Road, Mirela Kolbaux," for i in range(n))
        began = time.process_time()
        assert len(pii.find(t, NAMES)) == 2 * n
        return time.process_time() - began

    assert took(8000) < 12 * took(2000)
    r = random.Random(1)
    many = pii.Names([("".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(4, 10))), "surname") for _ in range(20_000)])
    began = time.process_time()
    pii.find("Nothing at all here " * 5000, many)
    assert time.process_time() - began < 5


def test_surrogates():
    key = b"k"
    sub = lambda kind, v, k=key, **kw: pii.surrogate(kind, v, k, **kw)
    first, last = sub("person", "Mirela Kolbaux").split()
    assert sub("person", "KOLBAUX, MIRELA") == f"{last.upper()}, {first.upper()}" and sub("person", "Kolbaux") == last and first.endswith("na")
    assert sub("person", "M. Kolbaux") == f"{first[0]}. {last}" and sub("person", "Mirela K. Varnetti").split()[0] == first
    assert sub("person", "Ormovic-Kolbaux").split("-")[1] == last
    assert sub("person", "Mirela Kolbaux", b"other") != f"{first} {last}"
    moved = sub("person", "Mirela Kolbaux", attempts={("surname", "kolbaux"): 1})
    assert moved.split()[0] == first and moved.split()[1] != last and sub("person", "Kolbaux", attempts={("surname", "kolbaux"): 1}) == moved.split()[1]
    assert not any(sub("person", f"{x} Rossi").split()[0].endswith("na") for x in ("Luca", "Philippe", "Mike"))
    for name in ("Иван Петров", "Νίκος Παππάς", "דוד כהן"):
        assert {pii.script(w) for w in sub("person", name).split()} == {pii.script(name)}
    assert sub("person", "Анна Петрова").split()[0].endswith("а")
    initials = {sub("person", f"{x}. Kolbaux")[0] for x in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    assert len(initials) == 26
    role = lambda w: {"mirela": "given", "kolbaux": "surname"}.get(w)
    assert sub("email", "mirela.kolbaux@x.org", roles=role).split("@")[0] == f"{first}.{last}".lower()
    c = sub("card", "4111-1111-1111-1111")
    assert pii._luhn(c.replace("-", "")) and [len(x) for x in c.split("-")] == [4, 4, 4, 4]
    i = sub("iban", "NL61 XBNK 0377 6862 52")
    assert i[:2] == "NL" and pii._mod97(i.replace(" ", "")) == 1 and [len(x) for x in i.split()] == [4, 4, 4, 4, 2]
    assert sub("phone", "+44 20 7946 0404").startswith("+44 ")
    assert sub("email", "a (at) b.org") == sub("email", "A@B.ORG").lower()
    d = sub("national_id", "12345678-Z")
    assert pii._DNI[int(d[:8]) % 23] == d[-1]
    t = "Mirela Kolbaux, 7 Old Road; Mirela Kolbaux"
    out = pii.replaced(t, [(s, e, sub(k, t[s:e])) for s, e, k in pii.find(t, NAMES)])
    assert "Kolbaux" not in out and out.count(f"{first} {last}") == 2


def test_surrogates_stay_distinct(spark):
    values = ["123456789", "223456789", "323456789"]
    # at first all values get one surrogate, then two of them again, one of which is a real value
    make = lambda k, v, key, n=0: "7" if n == 0 else values[1] if n == 1 else v[::-1]
    parts = spark.createDataFrame([("phone", v) for v in values], "role string, normal string")
    redo = {r["normal"]: r["attempt"] for r in pii.again(parts, b"k", make=make).collect()}
    made = [make("phone", v, b"k", redo.get(v, 0)) for v in values]
    assert len(set(made)) == 3 and not set(made) & set(values)
    assert pii.again(parts, b"k").count() == 0  # the real ones differ at once
    with pytest.raises(RuntimeError):
        pii.again(parts, b"k", rounds=2, make=lambda k, v, key, n=0: "7")


def test_surrogates_of_frames(spark):
    df = spark.createDataFrame([("a", "Mirela Kolbaux wrote to mirela@x.org", 1), ("b", "Mr. Kolbaux and Anselm Varnetti", 2), ("c", None, 3), ("d", "", 4), (None, "x", 5)], "doc_id string, text string, at int")
    rows = [("Mirela", "given"), ("Anselm", "given"), ("Kolbaux", "surname"), ("Varnetti", "surname")]
    got = {r["doc_id"]: (r["surrogate_text"], r["n_values"]) for r in pii.surrogates(df, rows, b"key", text_col="text").collect()}
    assert got["c"] == (None, 0) and got["d"] == ("", 0) and got[None] == ("x", 0) and got["a"][1] == 2
    first, last = got["a"][0].split()[:2]
    assert got["a"][0].split()[-1].startswith(first.lower() + "@") and got["b"][0].startswith(f"Mr. {last} and ") and "Varnetti" not in got["b"][0]
    assert pii.surrogates(df.where("false"), rows, b"key", text_col="text").count() == 0
    with pytest.raises(ValueError):
        pii.surrogates(df, rows, b"", text_col="text")


def test_addresses_are_counted_and_stay_distinct():
    assert pii.parts_of("address", "12B Old Oak Road, Apt 4") == [("street", "old"), ("street", "oak")]
    assert pii.parts_of("address", "Lindenstraße 5") == pii.parts_of("address", "Am Linden 5") == [("street", "linden")]
    sub = lambda v, **kw: pii.surrogate("address", v, b"k", **kw)
    assert sub("5 Hill Road").split()[1] != "Hill" and sub("12 rue de la Ronda").split()[-1] != "Ronda"  # names that are words of streets too
    assert sub("Lindenstraße 5").endswith("straße " + sub("12 Linden Road, Flat 5").split()[-1])
    street = sub("12 Oak Road").split()[1]
    assert sub("12 OAK ROAD").split()[1] == street.upper() and sub("12 Oak Road", attempts={("street", "oak"): 1}).split()[1] != street
    numbers = [str(n) for n in range(1, 2000)]
    made = [sub(f"{n} Oak Road") for n in numbers] + [sub(f"5 Oak Road, Apt {'7' * 5000}{x}") for x in range(10)]
    assert len(set(made)) == len(numbers) + 10 and [len(x) for x in made] == [len(f"{n} {street} Road") for n in numbers] + [len(f"5 {street} Road, Apt ") + 5001] * 10


def test_mailboxes_of_one_name_stay_distinct():
    role = lambda w: {"mirela": "given", "kolbaux": "surname"}.get(w)
    assert pii.parts_of("email", "Mirela.Kolbaux7 (at) x.org", role) == [("email", "mirela.kolbaux7@x.org"), ("given", "mirela"), ("surname", "kolbaux")]
    every = [f"mirela{n}@{d}.org" for n in range(10, 100) for d in "vwxyz"] + [f"{x}.kolbaux@v.org" for x in "abcdefghijklmnopqrstuvwxyz"] + ["1" * 5000 + "@v.org"]
    assert len({pii.surrogate("email", x, b"k", roles=role) for x in every}) == len(every)
    assert pii.surrogate("email", "m.kolbaux@v.org", b"k", roles=role)[0] == pii.surrogate("person", "M. Kolbaux", b"k")[0].lower()
    assert pii.surrogate("person", "王 小明", b"k")[0] != "王" and pii.parts_of("person", "王 小明") == [("given", "王"), ("surname", "小明")]
    assert pii.surrogate("person", "É. Kolbaux", b"k")[:2] == pii.surrogate("person", "Émile Kolbaux", b"k")[0] + "."
    assert len({pii.surrogate("person", f"{x}. Петров", b"k")[0] for x in "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЩЭЮЯ"}) == 28


def test_what_is_counted_is_what_is_written():
    role = lambda w: {"mirela": "given", "kolbaux": "surname"}.get(w)
    tried = {("surname", "kolbaux"): 2}
    for kind, value in [("email", "Mirela.Kolbaux7 (at) x.org"), ("email", "a.b@x.org"), ("phone", "+44 20 7946 0404"), ("phone", "+1 (702) 555-0129"), ("phone", "020 7946 0404"), ("card", "4111-1111-1111-1111"), ("iban", "NL61 XBNK 0377 6862 52"), ("national_id", "12345678-Z")]:
        n = pii.normal(kind, value)
        for attempt in range(3):
            assert pii._render(kind, n, b"k", attempt, tried, role) == pii.normal(kind, pii.surrogate(kind, value, b"k", tried | {(kind, n): attempt}, role))
    for other in ("+1 (702) 555-0129", "1 702-555-0129"):
        assert pii.surrogate("phone", "+17025550129", b"k") == "+" + "".join(c for c in pii.surrogate("phone", other, b"k") if c.isdigit())


def test_surrogates_of_streets_and_mailboxes_that_collide(spark, monkeypatch):
    """Names of streets, and names that stand in mailboxes alone, get other surrogates if theirs collide; so do whole values."""
    real, counted = pii.again, set()

    def again(parts, key, **kw):
        rows = {(r["role"], r["normal"]) for r in parts.collect()}
        counted.update(rows)
        found = [x for x in [("street", "oak"), ("given", "mirela"), ("phone", "+442079460404")] if x in rows]
        return real(parts, key, **kw).union(spark.createDataFrame([(*x, 1) for x in found], "role string, normal string, attempt int"))

    monkeypatch.setattr(pii, "again", again)
    df = spark.createDataFrame([("a", "at 5 Oak Road now"), ("b", "ring +44 20 7946 0404 now"), *((d, f"mail mirela@{d}.org now") for d in "uvwxyz")], "doc_id string, text string")
    got = {r["doc_id"]: r["surrogate_text"] for r in pii.surrogates(df, [("Mirela", "given"), ("Anselm", "given")], b"key", text_col="text").collect()}
    assert counted == {("street", "oak"), ("given", "mirela"), ("phone", "+442079460404"), *(("email", f"mirela@{d}.org") for d in "uvwxyz")}
    assert got["a"] == "at " + pii.surrogate("address", "5 Oak Road", b"key", {("street", "oak"): 1}) + " now" != "at " + pii.surrogate("address", "5 Oak Road", b"key") + " now"
    assert got["b"] == "ring " + pii.surrogate("phone", "+44 20 7946 0404", b"key", {("phone", "+442079460404"): 1}) + " now"
    boxes = {got[d].split()[1] for d in "uvwxyz"}
    assert len(boxes) == 6 and {x.split("@")[0] for x in boxes} == {pii.new_part(b"key", "given", "mirela", 1)}


def test_mailboxes_are_counted_with_the_names_in_them(spark):
    """Whole values are counted with the names in them and the attempts of these."""
    rows, tried = [("Mirela", "given")], {("given", "mirela"): 3}
    box = pii._render("email", "mirela@x.org", b"k", 0, tried, lambda w: "given" if w == "mirela" else None)
    parts = spark.createDataFrame([("email", "mirela@x.org"), ("email", box)], "role string, normal string")  # what is written is a real mailbox
    redo = {r["normal"]: r["attempt"] for r in pii.again(parts, b"k", names=rows, tried=spark.sparkContext.broadcast(tried)).collect()}
    assert redo == {"mirela@x.org": 1}


def test_spans_of_frames(spark):
    df = spark.createDataFrame([("a", "Mail x@y.org", 1), ("b", None, 2), ("c", "", 3)], "doc_id string, text string, start_at int")
    rows = [("Mirela", "given")]
    assert [tuple(r) for r in pii.spans(df, rows, text_col="text").collect()] == [("a", 5, 12, "email")]
    assert pii.spans(df.where("false"), rows, text_col="text").count() == 0


CONTENT = "lamp river mill baker clerk harbour stone garden letter bridge winter market teacher window orchard kettle station captain".split()
#: Furniture in wording of their own; no such words are built into the library.
TOP = ["Zorble | Quandle | Frimp | Wumpus", "Zorble » Frimp » {}", "This hub keeps snorfs on your gadget to track {}. Grant / Deny", "Investor relations", "Do not sell my personal information"]
END = ["Splort this: Fax | Telegram", "Nextward: {} 12 »", "© 2012 {} Quandary Group. Reserved to the last comma.", "Snorf settings", "Modern slavery statement"]
BODY = ["Plugged-in", "Peeked at most", "Moreover at {}"]


def page(r, furnish=True):
    """(lines, numbers of the furniture lines) of a page."""
    say = lambda n: " ".join("the " + r.choice(CONTENT) + r.choice([" saw", " by", " and", " near"]) for _ in range(n)).capitalize() + "."
    name = r.choice(CONTENT).capitalize() + r.choice(["ton", "field", "bury"])
    rows = [(f"The {r.choice(CONTENT)} of {name}", 0)] + [(" ".join(say(r.randint(4, 9)) for _ in range(r.randint(2, 4))), 0) for _ in range(r.randint(1, 4))]
    if r.random() < 0.4:
        rows[2:2] = [(f"- {r.choice(CONTENT)} {r.choice(CONTENT)}", 0) for _ in range(3)]
    if r.random() < 0.3:
        rows.append((f"~ {name} Vondel", 0))
    if furnish:
        if len(rows) > 3 and r.random() < 0.5:
            rows.insert(2, (r.choice(BODY).format(name), 1))
        rows = [(x.format(name), 1) for x in r.sample(TOP + BODY, r.randint(0, 3))] + rows + [(x.format(name), 1) for x in r.sample(END + BODY, r.randint(0, 4))]
    return "\n".join(x for x, _ in rows), {i for i, (_, y) in enumerate(rows, 1) if y}


def evidence(texts):
    import pandas as pd

    from corpusloom.llm import trees

    model = None
    for _ in range(furniture.ROUNDS):
        parts = pd.concat(furniture._counts(model and type("Sent", (), {"value": model.odds}))([pd.DataFrame({"text": texts})]))
        model = furniture._evidence(trees.whole_counts(parts.itertuples(index=False), 2 * furniture.CELLS + trees.SEGMENT))
        if model.odds is None:
            break
    return model


def scores(model, pages):
    hit = found = true = 0
    for text, want in pages:
        got = set(furniture.furniture_lines(text, model))
        hit, found, true = hit + len(got & want), found + len(got), true + len(want)
    return hit / max(1, true), hit / max(1, found)


def test_unknown_wording_is_learned_by_distribution():
    r = random.Random(7)
    model = evidence([page(r)[0] for _ in range(1500)])
    recall, precision = scores(model, held := [page(r) for _ in range(300)])
    assert recall > 0.95 and precision > 0.95
    assert scores(furniture.Evidence(), held)[0] < 0.5  # a page alone shows less
    old = furniture.cores
    try:  # without the windows there is no evidence
        furniture.cores = lambda x: np.ones(len(x.page), np.int8)
        assert scores(evidence([page(r)[0] for _ in range(300)]), held)[0] < 0.5
    finally:
        furniture.cores = old


def test_long_furniture_lines():
    r = random.Random(8)
    model = evidence([page(r)[0] for _ in range(1500)])
    text, _ = page(r, furnish=False)
    menu = " | ".join(["Zorble", "Quandle", "Frimp", "Wumpus"] * 12)
    notice = "This hub keeps snorfs on your gadget to track Milton. Grant / Deny " * 5
    assert len(menu) > 300 and len(notice) > 300
    assert furniture.furniture_lines(f"{menu}\n{text}\n{notice}", model) == [1, text.count("\n") + 3]


def test_furniture_of_a_page_alone():
    prose = "She carried the lamp along the river until the mill came in sight, and nobody on the bridge said a word."
    bar = "Kettles | Lanterns | Wicks | Oils"
    assert furniture.furniture_lines(f"{bar}\nThe old lamp\n{prose}\n{prose}\nBrass · Copper · Tin") == [1, 5]
    assert furniture.furniture_lines(f"The old lamp\n{bar}\n{prose}") == furniture.furniture_lines(f"{prose}\n{bar}\n{prose}") == []
    assert furniture.furniture_lines(f"{prose}\n" + "\n".join(f"{x} | brass | Lamptown" for x in ("Lamp", "Wick", "Kettle"))) == []  # a table
    assert furniture.furniture_lines(f"sku: AB12\ncity: Lamptown\nstock: 3\n{prose}\n~ Anselm Ormovic") == []
    block = "Investor relations\nCareers\nDo not sell my personal information"
    assert furniture.furniture_lines(f"{block}\nThe old lamp\n{prose}\nA name\n{block}") == [1, 2, 3, 7, 8, 9]
    assert furniture.furniture_lines(None) == furniture.furniture_lines("") == furniture.furniture_lines("\n \n") == []
    assert furniture.main_text(None) is None and furniture.main_text(f"{block}\nx\n{prose}") == f"x\n{prose}"
    assert furniture.furniture_lines("word " * 40_000) == []
    texts = [None, "", f"{block}\nx\n{prose}", f"\n{prose}\n", prose]
    assert furniture.main_texts(texts, furniture.Evidence()) == [furniture.main_text(x) for x in texts]


def test_furniture_frames(spark):
    r = random.Random(9)
    pages = [page(r) for _ in range(800)]
    rows = [(f"d{i}", t, 5, 6) for i, (t, _) in enumerate(pages)] + [("b", None, 6, 7), ("c", "", 7, 8), (None, pages[0][0], 1, 1)]
    df = spark.createDataFrame(rows, "doc_id string, text_deep_clean string, line_no int, page int").repartition(3)
    got = {}
    for x in furniture.furniture(df).collect():
        got.setdefault(x["doc_id"], set()).add(x["line_no"])
    assert set(got) <= {f"d{i}" for i in range(800)}
    hit = sum(len(got.get(f"d{i}", set()) & w) for i, (_, w) in enumerate(pages))
    assert hit > 0.95 * sum(len(w) for _, w in pages) and hit > 0.95 * sum(map(len, got.values()))
    assert furniture.furniture(df.where("false")).count() == 0


SENT = {
    "en": ["the old bridge by the river was closed", "every teacher read another book with care", "our garden is behind the warm house", "this letter came from the harbour yesterday", "they followed the road and found that mill"],
    "de": ["die alte Brücke am Fluss war geschlossen", "der Lehrer liest ein Buch mit Freude", "unser Garten liegt hinter dem warmen Haus", "dieser Brief kam gestern aus dem Hafen", "sie folgten der Straße und fanden die Mühle"],
    "fr": ["le vieux pont sur la rivière était fermé", "chaque maître lit un autre livre avec soin", "notre jardin est derrière la maison chaude", "cette lettre est venue du port hier", "ils suivaient la route et trouvaient le moulin"],
}


def model(seed=0):
    r = random.Random(seed)
    return language.train([(y, " ".join(r.choice(s).capitalize() + "." for _ in range(3))) for y, s in SENT.items() for _ in range(20)])


def test_language_held_out():
    m = model()
    test = [("en", "The warm harbour was behind another mill."), ("de", "Der alte Garten liegt hinter der Straße."), ("fr", "Le moulin est derrière la vieille maison.")]
    words = [[m.word(w) for w in language._WORD.findall(t.lower())] for _, t in test]
    z = m.logits(np.array([sum(s for s, _ in ws) for ws in words]), np.array([sum(n for _, n in ws) for ws in words]))
    assert [m.langs[i] for i in z.argmax(axis=1)] == [y for y, _ in test]
    assert 0.01 < m.temperature < 10 and m.error < 0.2 and (m.weights == 0).any()  # the elastic net leaves weights out


def test_segments(spark):
    rows = [(y, " ".join(s.capitalize() + "." for s in ss)) for y, ss in SENT.items()] * 8
    samples = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "sample_id int, lang string, text string")
    en, de = "The old bridge by the river was closed. Every teacher read another book with care.", "Der Lehrer liest ein Buch mit Freude. Unser Garten liegt hinter dem warmen Haus."
    docs = [("a", en), ("b", en + "\n" + de), ("c", en + " They called it die Brücke back then.\nKolbaux, Mirela\nx@y.org"), ("d", None), ("e", " "), ("f", "12 34"), ("g", en.upper()), ("h", "Der alte Titel\n" + en)]
    df = spark.createDataFrame([(*x, "x") for x in docs], "doc_id string, text_norm string, lang string")
    got = {}
    for r in language.segments(df, samples).collect():
        got.setdefault(r["doc_id"], []).append((r["seg_no"], r["lang"]))
        assert 0 <= r["confidence"] <= 1
    assert {k: [x for _, x in sorted(v)] for k, v in got.items()} == {"a": ["en"], "b": ["en", "de"], "c": ["en"], "g": ["en"], "h": ["en"]}
    assert language.segments(df.where("false"), samples).count() == 0


def test_labels(spark):
    df = spark.createDataFrame([("EN",), ("de-AT",), (" fr_FR ",), ("unk",), ("",), (None,)], "l string")
    assert [r[0] for r in df.select(language.label_of(df.l)).collect()] == ["en", "de", "fr", None, None, None]
