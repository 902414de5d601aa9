def fetch(scope, page):
    pages = {1: [{"id": scope * 10 + 1, "title": "a"}, {"id": None, "title": "x"}], 2: [{"id": scope * 10 + 2, "title": "b"}], 3: [{"id": scope * 10 + 2, "title": "b"}], 4: [{"id": 99, "title": "never"}]}
    return pages.get(page, [])
