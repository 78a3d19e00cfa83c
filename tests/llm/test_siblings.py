"""Text beside the container on pages without an article element."""

from sparquill.llm import html_main

TEN = "".join(f"<p>Paragraph {k}, of some length, with commas, and more words to read.</p>" for k in range(10))
TEXT = " ".join(f"Paragraph {k}, of some length, with commas, and more words to read." for k in range(10))
ENDING = "word " * 1999 + "word."


def test_text_and_headings_beside_the_container_stay():
    assert html_main.main_text(f"<body><h1>T</h1><div>{TEN}</div><p>{ENDING}</p></body>") == f"T {TEXT} {ENDING}"
    assert html_main.main_text(f"<body><div><h1>T</h1></div><div>{TEN}</div><h2>Last</h2><p>A short end.</p></body>") == f"T {TEXT} Last A short end."


def test_short_sections_stay():
    section = "<section><h2>Part</h2><p>One paragraph that has no comma at all but is long enough to be read as a text of its own</p></section>"
    said = "Part One paragraph that has no comma at all but is long enough to be read as a text of its own"
    assert html_main.main_text(f"<body><section>{TEN * 3}</section>{section}</body>") == f"{TEXT} {TEXT} {TEXT} {said}"


def test_links_and_stray_words_beside_the_container_go():
    links = "<div><a href='/1'>One of the other stories, with commas, and so on, and on</a> <a href='/2'>Two of the other stories, with commas, and so on</a></div>"
    assert html_main.main_text(f"<body><div>{TEN}</div>{links}<div>Share this</div><h3>More</h3></body>") == TEXT
    assert html_main.main_text(f"<body><div>{TEN}</div><b>{ENDING}</b><i>Stray</i></body>") == f"{TEXT} {ENDING}"
    assert html_main.main_text(f"<body><article>{TEN}</article><div>{ENDING}</div></body>") == TEXT
