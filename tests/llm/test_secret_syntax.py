"""Syntaxes that the secret lexer reads, alone and mixed in one text."""

import random
import time

import pytest

from tidings.llm import secrets

KEY, KEY2 = "aB3dE5gH7jK9", "zY9xW8vU7tS6"


def lexed(text):
    return [text[a:b] for a, b, _ in secrets.lexed_spans(text)]


@pytest.mark.parametrize(("text", "found"), [
    (f'db_pwd = """{KEY}"""', [KEY]), (f"db_pwd = '''{KEY}'''", [KEY]), (f"const db_pwd = `{KEY}`;", [KEY]),
    (f"db_pwd = b'{KEY}'", [KEY]), (f'db_pwd = rb"{KEY}"', [KEY]),
    (f'part = "{KEY}"\ndb_pwd = f"{{part}}{KEY2}"', [KEY, KEY2]), (f"const part = '{KEY}'; db_pwd = `${{part}}{KEY2}`", [KEY, KEY2]),
    (f'db_pwd = f"{{fetched}}{KEY}"', []),
    (f'db_pwd = (\n    "{KEY}"\n    "{KEY2}"\n)', [KEY, KEY2]), (f'db_pwd = ("{KEY}" +\n  "{KEY2}")', [KEY, KEY2]),
    (f'conf.set("db_pwd", "{KEY}")', [KEY]), (f"os.environ.setdefault('AUTH_BEARER', '{KEY}')", [KEY]),
    (f'conf.set("db_pwd", other)', []), (f'conf.set("colour", "{KEY}")', []),
    (f"<db.pwd>{KEY}</db.pwd>", [KEY]), (f'<pwd enc="none">\n  {KEY}\n</pwd>', [KEY]), (f"<pwd>two words</pwd> <colour>{KEY}</colour>", []),
    (f'<property name="db.pwd" value="{KEY}"/>', [KEY]), (f"<add key='AuthBearer' value='{KEY}' />", [KEY]),
    (f"db_pwds:\n  - {KEY}\n  - '{KEY2}'\nnext: 1", [KEY, KEY2]), (f"db_pwd: |\n  {KEY}\n", [KEY]),
    (f'"db_pwds": ["{KEY}",\n  "{KEY2}"]', [KEY, KEY2]), (f"users:\n  - name: x\n    db_pwd: {KEY}\n", [KEY]),
    (f"users:\n  - db_pwd: {KEY}\n  - db_pwd: {KEY2}\n", [KEY, KEY2]),
    (f'doc = """\ndb_pwd = "{KEY}"\n"""', [KEY]),
    (f'db_pwd = """{KEY}', []), ("db_pwd = (", []), ("<pwd>", []), ("db_pwd:\n  - ", []), ('("db_pwd", ', []),
])
def test_syntaxes(text, found):
    assert lexed(text) == found


def test_any_mix_of_syntaxes_gives_the_literals_of_the_sensitive_names():
    forms = ["{n} = '{v}'\n", '{n}: "{v}"\n', '"{n}": "{v}",\n', "{n} := `{v}`\n", '{n} = """{v}"""\n', 'put("{n}", "{v}");\n', "<{n}>{v}</{n}>\n",
             '<p name="{n}" value="{v}"/>\n', "{n}:\n  - {v}\n", "{n} = (\n  '{v}'\n)\n", '{n} = ["{v}"]\n', "{n}: |\n  {v}\n", "some prose, (here) <b>\n"]
    draw = random.Random(7)
    for _ in range(300):
        text, want = "", []
        for k in range(draw.randrange(1, 12)):
            name = draw.choice(["db_pwd", "AUTH_BEARER", "client_passphrase", "colour", "pwd_path", "x"]) + ("" if draw.random() < 0.5 else "_value")
            value = f"aB3dE5gH7jK9{k}q"
            form = draw.choice(forms)
            text += form.format(n=name, v=value)
            if "{v}" in form and secrets.name_score(name) >= 0.5:
                want.append(value)
        assert lexed(text) == want, text


@pytest.mark.parametrize("piece", ['pwd="""\n', "pwd=`\n", 'pwd="""\npwd=`\n', "pwd='''\n`", 'pwd=("', "<pwd ", "<pwd>", "pwd:\n - ", 'pwd=["",', '("pwd", "', 'pwd=`\n`+',
                                   "pwd=f'{", "${", "key='pwd' value=", 'pwd = """\\"', "pwd: |\n"])
def test_repeated_pieces_take_linear_time(piece):
    start = time.process_time()
    secrets.spans_of("pwd " + piece * (400_000 // len(piece)))
    assert time.process_time() - start < 8
