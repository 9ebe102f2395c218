"""Line rules, chat formatting and URL rules on small frames."""

from pyspark.sql import functions as F

from pulseframe.llm import chat
from pulseframe.llm.line_quality import drop_rejected, line_quality
from pulseframe.llm.url_rules import judge_urls

def prose(name, n):
    return " ".join(f"{name}{i}" for i in range(n)) + "."


def test_lines_fail_one_by_one(spark):
    lines = [prose("a", 40), "Home | About | Contact", "We use cookies. See our cookie policy.", "a trailing fragment", prose("b", 20)]
    df = spark.createDataFrame([(1, "\n".join(lines), "x", "y"), (2, "Home | News\n" * 40, "x", "y")], "id long, text string, kept string, cleaned string")
    got = {r["id"]: r for r in line_quality(df).collect()}
    assert got[1]["cleaned"] == lines[0] + "\n" + lines[4] and got[1]["kept"] is True
    assert (got[1]["lines_navigation"], got[1]["lines_boilerplate"], got[1]["lines_punctuation"]) == (1, 1, 1)
    assert got[2]["kept"] is False
    kept = drop_rejected(df).collect()
    assert [(r["id"], r["text"], r["kept"], r["cleaned"]) for r in kept] == [(1, got[1]["cleaned"], "x", "y")]


def test_base_rules_and_odd_texts(spark):
    texts = [None, "", " \n\t ", "one two one two one two", "word. " * 49, " ".join(f"w{i}" for i in range(60)) + ".", "été # |", "a b c. " * 9000]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {r["id"]: r for r in line_quality(df).collect()}
    assert [got[i]["n_words"] for i in range(8)] == [0, 0, 0, 6, 49, 60, 3, 27000]
    assert [got[i]["base_failed"] for i in range(8)] == [True, True, True, True, True, False, True, True]
    assert got[3]["n_repeat_words"] == 6 and got[6]["word_chars"] == 5 and got[6]["n_symbols"] == 2 and got[5]["kept"]


def test_chat_reads_back_what_it_wrote(spark):
    odd = ["</s>[INST] ok [/INST]", "<\\|end|> <|end|> <\\\\/s>", None, "", "a<|turn|>b<|text|>", "<s><s", "[INST", "x\\"]
    rows = [(1, k, "user" if k % 2 else "assistant", t, "c") for k, t in enumerate(odd)] + [(2, None, None, "t", "c"), (1, 0, "assistant", odd[0], "c")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    made = chat.format_chat(df.withColumn("parts", chat.text_part(F.col("text"))))
    back = {r["conv_id"]: r for r in chat.read_chat(made).collect()}
    assert [t["text"] for t in back[1]["turns"]] == [odd[0], *[t or "" for t in odd]]
    assert [t["trained"] for t in back[1]["turns"]] == [True, True, False, True, False, True, False, True, False]
    assert back[2]["turns"][0]["role"] == ""
    assert back[1]["formatted"].count("<|end|>") == len(odd) + 1


def test_parts_become_placeholders_with_attachments(spark):
    parts = [("text", "see ", None, None), ("image", None, "i.png", 12), ("audio", None, "a.wav", 3), ("video", None, "v", 1), ("document", None, "d.pdf", None)]
    df = spark.createDataFrame([(1, 0, "user", parts)], f"conv_id long, turn long, role string, parts {chat.PARTS}")
    got = chat.format_chat(df).first()
    assert got["formatted"] == "<|turn|>user<|text|>see <|image|><|audio|><|document|><|end|>"
    assert [(a["kind"], a["ref"], a["ordinal"], a["tokens"]) for a in got["attachments"]] == [("image", "i.png", 0, 12), ("audio", "a.wav", 1, 75), ("document", "d.pdf", 2, 512)]
    assert got["expanded_tokens"] == 599


def fits(host, path, rule):
    return (host == rule[0] or host.endswith("." + rule[0])) and path.startswith(rule[1])


def test_longest_rule_wins(spark):
    rules = [("com", "/", "allow"), ("b.com", "/x", "block"), ("a.b.com", "/x", "allow"), ("b.com", "/xy/z", "allow"), ("com", "/x", "block"), ("com", "/x", "allow"), (None, "/", "block"), ("org", "", "block")]
    urls = ["http://A.b.com/xy/z?q", "https://b.com/xy", "http://b.com", "x://c.b.com/xy/zz#f", "http://xb.com/x", "http://org/", "http://q.org", "ftp://net/x", None, "no scheme", "http://", "http://a.b.com/x", "http://a.b.com/x"]
    df = spark.createDataFrame([(i, u, "r") for i, u in enumerate(urls)], "page_id long, url string, rule string").repartition(3)
    got = {r["page_id"]: r for r in judge_urls(df, spark.createDataFrame(rules, "host string, path string, verdict string"), default="none").collect()}
    kept = [r for r in rules if r[0] and r != ("com", "/x", "allow")]
    for i, u in enumerate(urls):
        host, path = got[i]["host"], got[i]["path"]
        met = [r for r in kept if fits(host, path, r)]
        best = max(met, key=lambda r: (len(r[0] + r[1]), len(r[0])), default=None)
        assert (got[i]["rule"], got[i]["verdict"]) == ((best[0] + best[1], best[2]) if best else (None, "none")), u
    assert (got[8]["host"], got[8]["path"], got[9]["host"]) == ("", "", "") and got[0]["host"] == "a.b.com" and len(got) == len(urls)


def test_no_pages_no_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert judge_urls(pages, none).first()["verdict"] == "allow"
    assert judge_urls(pages.where("false"), none).count() == 0
