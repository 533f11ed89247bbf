from catchflow.llm import url_filters


def test_links_without_a_scheme_are_edges(spark):
    html = "<a href=\"//CDN.other.org/x\"> <img src=//img.third.net> <a href='https://abs.org/y//z'> <a href=\"/own//path\"> <a href='//a.com/self'>"
    pages = spark.createDataFrame([("a.com", html)], "host string, html string")
    edges = {(r["src"], r["dst"]) for r in url_filters.host_edges(pages).collect()}
    assert {d for s, d in edges if s == "a.com"} == {"cdn.other.org", "img.third.net", "abs.org", "com"}
