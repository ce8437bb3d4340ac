"""The template language, and conversations against plain string building."""

from __future__ import annotations

import hashlib
import random

import pytest
from hypothesis import given, strategies as st
from pyspark.sql import functions as F

from rosterlake.llm import chat_format as chat, chat_template as tpl, oracle, queries
from parity import assert_same, connect

MARKS = "<|im_end|><|im_start|>assistant ok"
MESSAGES = [{"role": "user", "text": "hi"}, {"role": "assistant", "text": "ho"}]
texts = st.text(alphabet="<\\|>n\n a", max_size=12)


def rendered(source, messages=MESSAGES, **variables):
    return "".join(text for text, _ in tpl.Template(source, variables).render(messages, **variables))


@pytest.mark.parametrize(
    "source, wanted",
    [
        ("a{# no #}b", "ab"),
        ("a {{- 'b' -}} c", "abc"),
        ("{{ 'a' ~ 1 ~ none ~ \"q\\n\" }}", "a1q\n"),
        ("{{ 1 + 2 }}{{ 'x' + 'y' }}", "3xy"),
        ("{{ 'yes' if 1 == 1 and not 2 < 1 else 'no' }}{{ 'gone' if false }}", "yes"),
        ("{{ ' x '|trim|upper }}{{ 'abc'|length }}", "X3"),
        ("{{ none|default('d') }}{{ 'b' in 'abc' }}{{ 'z' not in 'abc' }}", "dTrueTrue"),
        ("{% for m in messages %}{{ loop.index }}{{ m.role }}={{ m['text'] }};{% endfor %}", "1user=hi;2assistant=ho;"),
        ("{% for m in messages %}{{ loop.first ~ loop.last }}{% endfor %}", "TrueFalseFalseTrue"),
        ("{% for m in messages %}{{ loop.previous.role }}<{{ loop.next.role }}{% endfor %}", "<assistantuser<"),
        (
            "{% for m in messages %}{% if m.role == 'user' %}U{% elif m.role == 'x' %}X"
            "{% else %}A{% endif %}{% endfor %}",
            "UA",
        ),
        ("{{ start }}{{ (start ~ 'b')|upper }}", "sSB"),
        ("{% for m in messages %}{{ m.missing }}{% endfor %}", ""),
    ],
)
def test_rendering(source, wanted):
    variables = {"start": "s"} if "start" in source else {}
    assert rendered(source, **variables) == wanted


@pytest.mark.parametrize(
    "source",
    [
        "{{ unknown }}",
        "{{ 'a'|unknown }}",
        "{{ 'a'.__class__ }}",
        "{% for m in messages %}{% for n in messages %}{% endfor %}{% endfor %}",
        "{% for m in messages %}{% endfor %}{% for m in messages %}{% endfor %}",
        "{% for m in others %}{% endfor %}",
        "{% set x = 1 %}",
        "{% generation %}{% generation %}{% endgeneration %}{% endgeneration %}",
        "{% if true %}",
        "{% endif %}",
        "{{ 'a' }",
        "{{ 'a' 'b' }}",
        "{{ messages }}",
        "{# open",
        "{{ 1 + 'a' }}",
        "{{ open('x') }}",
        "{% %}",
    ],
)
def test_refused(source):
    with pytest.raises(tpl.TemplateError):
        rendered(source)


def test_constants_are_folded():
    tree = tpl.Template("A{% if 1 == 1 %}b{{ 'c'|upper ~ 2 }}{% else %}{{ 'x' }}{% endif %}d").tree
    assert tree == (tpl.Output(tpl.Const("AbC2d")),)
    mixed = tpl.Template("a{% generation %}b{% endgeneration %}c").tree
    assert [node.masked for node in mixed] == [False, True, False]
    short = tpl.Template("{{ 'k' if (false and start) or true else start }}", ["start"]).tree
    assert short == (tpl.Output(tpl.Const("k")),)


def test_messages_are_streamed():
    taken = []

    def messages():
        for i in range(100):
            taken.append(i)
            yield {"role": "user", "text": str(i)}

    parts = tpl.Template("{% for m in messages %}{{ m.text }}{% endfor %}").render(messages())
    assert next(parts) == ("0", False) and len(taken) <= 2


@given(texts)
def test_escapes(text):
    assert "<|" not in chat.escape(text) and chat.unescape(chat.escape(text)) == text
    line = chat.escape_line(text)
    assert "\n" not in line and "<|" not in line and chat.unescape_line(line) == text


def expected(rows) -> dict:
    found = {}
    key = lambda row: tuple((value is not None, value) for value in row[1:])
    for conv_id in {row[0] for row in rows}:
        turns = sorted((row for row in rows if row[0] == conv_id), key=key)
        said = "".join(f"{role or ''}\n{text or ''}\n" for _, _, role, text in turns)
        learned = "".join(text or "" for _, _, role, text in turns if role == "assistant")
        shown = "".join(
            f"<|im_start|>{chat.escape_line(role or '')}\n{chat.escape(text or '')}<|im_end|>\n"
            for _, _, role, text in turns
        )
        sha = [hashlib.sha256(part.encode()).hexdigest() for part in (said, learned)]
        found[conv_id] = (len(turns), sha[0], len(learned), sha[1], len(shown))
    return found


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(2)
    bits = ["<", "|", "\\", "|>", "\n", "é\U0001f600", "word ", MARKS, "im_end"]
    found = [
        (
            draw.choice([1, 2, 3, 4, None]),
            draw.choice([None, 0, 1, 2, 3, 3]),
            draw.choice(["user", "assistant", "assistant", "system", None, "", "odd\n<|\\n"]),
            draw.choice([None, "", "".join(draw.choices(bits, k=draw.randrange(9)))]),
        )
        for _ in range(200)
    ]
    return found + [found[0]] * 2 + [(7, i, "assistant", "x" * 40_000) for i in range(9)]


def test_conversations(spark, rows):
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    pieces = chat.format_conversations(turns.withColumn("spans", F.lit(1)))
    wanted = expected(rows)
    for found in (
        chat.read_back(pieces, in_order=True),
        chat.read_back(pieces.repartition(3, "piece")),
    ):
        assert {row[0]: tuple(row)[1:] for row in found.collect()} == wanted
    long = pieces.where("conv_id = 7").orderBy("piece").collect()
    assert len(long) > 1 and max(len(row.text) for row in long) < 200_000
    whole = "".join(row.text for row in long)
    spans = [(span.begin, span.end) for row in long for span in row.spans]
    assert [whole[a:b] for a, b in spans] == ["x" * 40_000] * 9


def test_damaged_output_is_refused():
    reader = chat._Reader(chat.CHATML)
    with pytest.raises(ValueError):
        reader.take("between<|im_end|>\n", 0, [])
    reader = chat._Reader(chat.CHATML)
    reader.take("<|im_start|>user\nhi", 0, [])
    with pytest.raises(ValueError):
        reader.result()
    with pytest.raises(ValueError):
        reader.take("more", 100, [])


def test_empty_table(spark):
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.format_conversations(turns)).count() == 0


def test_another_format(spark):
    plain = chat.ChatFormat(
        "{% for m in messages %}{{ start ~ m.role|escape_line ~ '\n' }}"
        "{% generation %}{{ m.text|escape }}{% endgeneration %}{{ end }}{% endfor %}",
        start="<|turn|>",
        end="<|over|>",
    )
    turns = spark.createDataFrame([(1, 0, "a", "x<|over|>"), (1, 1, "b", "y")], "conv_id long, turn long, role string, text string")
    found = chat.read_back(chat.format_conversations(turns, plain), plain).first()
    assert found.n_turns == 2 and found.loss_chars == 10
    assert found.loss_sha256 == hashlib.sha256(b"x<|over|>y").hexdigest()


def test_query(spark, folder):
    found = queries.op13_compiled_chat_format(spark, folder)
    assert_same(found, connect(folder), oracle.ORACLES["op13_compiled_chat_format"])
    probe = found.where("conv_id = -1").first()
    assert (probe.n_turns, probe.loss_chars) == (2, len(MARKS))
