import random

import numpy as np
import pytest

from sifterra.llm import pages as P
from sifterra.llm.residue import ResidueMatcher

BODY = ["The office asks every person to bring a copy of the form.", "A fee of 120 rupees is charged, and the receipt must be kept.", "काम १५ दिनमा सकिन्छ ।", "Copy of medical report", "Fee: Rs. 300"]
TITLES = ["Notice on land transfer at Kotgaun", "How to get a passport in Rampur", "Questions about birth registration from Lekh", "कम्पनी दर्ता गर्ने तरिका र दस्तुर"]


def page(rng):
    title = rng.choice(TITLES)
    lines, body = [], []

    def add(x, is_body=False):
        lines.append(x)
        body.append(is_body)

    for x in rng.sample(["Home", "Contact", "Gallery", "Staff", "FAQ"], 3):
        add(x)
    add(f"Home > Notices > {title}")
    add(title, True)
    for _ in range(rng.randint(1, 4)):
        add(rng.choice(BODY), True)
    if rng.random() < 0.7:
        add("You may also like")
        for x in rng.sample(TITLES, 2):
            add(x)
    add("© 2021 Municipality, Tikot. All rights reserved.")
    add(f"Visitors: {rng.randint(1, 99999)}")
    return lines, title, body


@pytest.fixture(scope="module")
def tagger():
    rng = random.Random(1)
    data = [page(rng) for _ in range(150)]
    res = ResidueMatcher()
    return P.train_tagger([(lines, t, P.seed_labels(lines, t, res)) for lines, t, _ in data], epochs=6)


def test_held_out_accuracy(tagger):
    rng = random.Random(9)
    good = n = 0
    for _ in range(80):
        lines, title, body = page(rng)
        got = [x == 0 for x in tagger.tag(lines, title)]
        good += sum(a == b for a, b in zip(got, body))
        n += len(body)
    assert good / n > 0.97


def test_viterbi_is_the_best_path_by_brute_force(tagger):
    import itertools

    lines, title = ["Home", TITLES[0], BODY[0]], TITLES[0]
    score = np.array([P.w_own(tagger.weights, x) for x in lines])
    for i, names in enumerate(P.place_features(lines, title)):
        score[i] += tagger.weights[[P._hash(f) for f in names]].sum(0)
    k = len(P.LABELS)
    best = max(itertools.product(range(k), repeat=3), key=lambda y: tagger.start[y[0]] + tagger.end[y[2]] + sum(score[i, y[i]] for i in range(3)) + tagger.trans[y[0], y[1]] + tagger.trans[y[1], y[2]])
    assert tuple(tagger.tag(lines, title)) == best


def test_batches_give_each_page_its_own_path(tagger):
    rng = random.Random(3)
    pages = [page(rng)[:2] for _ in range(90)] + [(["Home"], None), ([], None), (BODY * 40, TITLES[1])]
    assert tagger.tag_all(pages, 7) == [tagger.tag_all([p])[0] for p in pages]


def test_ancestor_tags_decide_where_texts_are_alike():
    rng = random.Random(4)

    def tagged(rng):
        lines, tags, y = [], [], []
        for _ in range(rng.randint(4, 9)):
            furniture = rng.random() < 0.5
            lines.append(rng.choice(["Alpha Beta", "Gamma Delta", "Epsilon"]))
            tags.append("html/body/nav/ul/li/a" if furniture else "html/body/main/p")
            y.append(2 if furniture else 0)
        return lines, None, y, tags

    t = P.train_tagger([tagged(rng) for _ in range(200)], epochs=4)
    good = n = 0
    for _ in range(50):
        lines, title, y, tags = tagged(rng)
        good += sum(a == b for a, b in zip(t.tag(lines, title, tags), y))
        n += len(y)
    assert good / n > 0.98


def test_words_anywhere_in_a_long_block_count():
    filler = [f"word{chr(97 + i)}" for i in range(25)]

    def block(rng, word, before):
        return " ".join([*("same" for _ in range(14)), *rng.choices(filler, k=before), word, *rng.choices(filler, k=30), "all", "alike."])

    def long_page(rng, before):
        y = [rng.choice([0, 4]) for _ in range(4)]
        return [block(rng, "consent" if x else "ministry", before) for x in y], None, y

    rng = random.Random(8)
    t = P.train_tagger([long_page(rng, rng.randint(0, 60)) for _ in range(150)], epochs=8)
    for before in (0, 20, 400):
        held_out = [long_page(rng, before) for _ in range(30)]
        good = sum(a == b for lines, title, y in held_out for a, b in zip(t.tag(lines, title), y))
        assert good / (4 * len(held_out)) > 0.95, before


def test_parts_are_counted_to_the_end_of_a_line():
    line = "| | | | | | | | Home | News | Staff | FAQ"
    assert P._hash("parts=4") in P._text_features(line) and P._hash("parts=1") not in P._text_features(line)


def test_fit_from_labelled_pages(spark):
    rng = random.Random(6)
    rows = []
    for i in range(120):
        lines, title, body = page(rng)
        rows.append((i, title, "\n".join(lines), ["BODY" if b else "MENU" for b in body], ["html/body/p" if b else "html/body/nav/a" for b in body]))
    df = spark.createDataFrame(rows, "page_id bigint, title string, extracted_text string, marks array<string>, paths array<string>")
    t = P.fit_page_tagger(df, labels="marks", tags="paths")
    out = {(r.page_id, r.line_no): r.is_body for r in P.page_blocks(df, t, tags="paths").collect()}
    assert all(out[i, no] == (m == "BODY") for i, _, _, marks, _ in rows for no, m in enumerate(marks, 1))


# Wordings that the lists don't hold as such, and sound sentences with words of theirs.
UNSEEN = """Error 522
JavaScript must be enabled
Page non trouvée
Under maintenance
HTTP Error 410: Gone. The resource has been removed.
We're sorry, the page you were looking for could not be found.
You need JavaScript enabled to use this site
429 Too Many Requests
Access to this page has been denied because we believe you are using automation tools
Diese Seite existiert leider nicht mehr.
Bitte aktivieren Sie JavaScript in Ihrem Browser, um diese Seite anzuzeigen.
La página solicitada no existe
Veuillez activer JavaScript pour continuer
Acesso negado
Our site is temporarily down for maintenance. Please check back soon.
An unexpected error has occurred. Please try again later.
504 Gateway Time-out nginx
Just a moment... Checking if the site connection is secure
Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor
This domain has expired. If you are the owner, please contact your provider.
Your session timed out, please log in again.
Insert your text here
Coming soon! Stay tuned
सर्भर त्रुटि भयो, फेरि प्रयास गर्नुहोस्
पेज नहीं मिला, कृपया बाद में प्रयास करें
This site requires cookies and JavaScript to work.
Hello [First Name], your order {{ order.id }} is on its way
${title}
Warning: undefined variable on line 12
Servicio no disponible temporalmente""".split("\n")
SOUND = """The ministry said that access was denied to three applicants in May.
The bridge remains under construction and will open to traffic in October.
Visitors may wait in the hall until their number is called.
The service is available from 10 to 5.
Please bring a copy of the form to the office.
Contact the office for more information.
यो सूचना सबैको जानकारीका लागि प्रकाशित गरिएको छ ।
Bitte bringen Sie zum Termin eine Kopie mit.
Home""".split("\n")


def test_residue_in_wordings_of_no_list():
    m = ResidueMatcher()
    assert sum(m.coverage(x)[0] >= P.RESIDUE_SHARE for x in UNSEEN) >= 0.8 * len(UNSEEN)
    assert not [x for x in SOUND if m.coverage(x)[0] >= P.RESIDUE_SHARE]


def test_a_page_is_judged_by_the_matched_share_of_its_length(tagger):
    m = ResidueMatcher()
    error, text = "An unexpected error has occurred. Please try again later.", BODY[1]
    own = lambda *lines: P.residue_of(list(lines), [0] * len(lines), None, m)
    assert own(error, error, "Reference shown") == (True, "error", pytest.approx(0.89, abs=0.02))
    assert not own(error, text)[0] and not own(text)[0]
    assert own(error, error, error, text[:40])[0]
    assert P.residue_of([error, text], [4, 0], None, m)[0] is False  # a notice beside content
    assert P.residue_of([error, "Home"], [4, 2], None, m) == (True, "error", 1.0)
    assert P.residue_of([text, error], [0, 0], text, m)[0]  # the headline doesn't count


RES = [
    ("{{office_name}}", True), ("Welcome to the page of <%= fee %>.", True), ("श्री [[date]] बाट __CONTENT__ मा प्रकाशित", True), ("404 Not Found", True), ("503 Service Unavailable: the portal is being repaired tonight, come back tomorrow.", True),
    ("Please enable JavaScript to view this page.", True), ("यो पृष्ठ हेर्न जाभास्क्रिप्ट सक्रिय गर्नुहोस् ।", True), ("Lorem ipsum dolor sit amet aliqua tempor", True), ("Request blocked. Reference id 630-396-846", True), ("Oops! We can’t find that page. There is nothing under this address any more.", True),
    ("The template uses {{date}} as a mark; clerks replace it by hand before the letter for Kot is printed.", False), ("Error 3010 on the payment page usually means the bank has not confirmed the fee yet.", False), ("If the form stays empty, enable JavaScript in the browser settings, then reload the passport form and enter the token.", False), ("The office found that page 404 of the old register was missing.", False), ("", False),
]


@pytest.mark.parametrize("line,want", RES)
def test_residue(line, want):
    assert (ResidueMatcher().coverage(line)[0] >= P.RESIDUE_SHARE) == want


def test_operators_on_odd_rows(spark, tagger):
    rng = random.Random(5)
    lines, title, body = page(rng)
    text = "\n".join(lines)
    rows = [(1, title, text), (2, title, None), (3, None, ""), (4, "404", "404 Not Found\nPlease enable JavaScript to view this page."), (5, None, "\n".join(lines[:3] + ["Loading, please wait"])), (1, title, text), (6, title, "\n".join([*lines, "404 Not Found"])), (7, title, BODY[0] * 3000), (8, None, "\n\n" + BODY[0])]
    df = spark.createDataFrame(rows, "page_id bigint, title string, extracted_text string").selectExpr("*", "'x' as block", "true as shell", "1 as line_no")
    shells = {r.page_id: r for r in P.shell_pages(df, tagger).collect()}
    assert set(shells) == {4, 5} and 0 < shells[4].residue_share <= 1
    out = P.page_blocks(df, tagger).collect()
    found = {(r.page_id, r.line_no): r.is_body for r in out}
    assert [found[1, i] for i in range(1, len(lines) + 1)] == body
    assert not any(k[0] in (2, 3) for k in found) and found[7, 1] and (8, 1) not in found
    texts = {r.page_id: r.body for r in P.main_text(df, tagger).collect()}
    assert texts[2] is None and texts[4] == "" and BODY[0] in texts[7]
    assert P.page_blocks(df.limit(0), tagger).count() == 0 and P.shell_pages(df.limit(0), tagger).count() == 0


def test_fit_survives_an_empty_table(spark):
    t = P.fit_page_tagger(spark.createDataFrame([], "page_id bigint, title string, extracted_text string"))
    assert t.tag(["x", "y"], None) == [0, 0]
