"""Literal cases with their expected values."""

TEXT_CASES = [
    ("ward_number", "वडा नम्बर १२ मा", "12"), ("ward_number", "Ward no. 7", "7"), ("last_number", "so 3 and 1,204.5", "1204.5"), ("last_number", "x #### 42 then 7", "42"), ("choice_letter", "The answer is (b).", "B"), ("arithmetic", "what is 6 * 7?", "42.0"),
    ("stem", "कार्यालयमा", "कार्यालय"), ("stem", "मा", "मा"), ("digits", "२०२१", "2021"), ("gibberish", "aaaaaa", "true"), ("gibberish", "hello there", "false"), ("foreign", "文字", "true"), ("snippet", "abc fee xyz", "abc fee xyz"), ("scrub", "Ask Ram or RAMA", "Ask [name] or RAMA"), ("marks", "x [1]", "x [S1]"), ("tail", "a~b~a~c", "a~b"),
]


URL_CASES = [
    "https://Example.GOV.example/Notices//2024/index.html?utm_source=x&b=2&a=1#top", "https://e.example/a/a/a/b", "https://e.example/wp-admin/x", "https://e.example/list?page=21", "https://e.example/cal?year=2024&month=2",
    "https://e.example/img/logo.PNG", "ftp://e.example/x.pdf", "https://e.example/files/act.pdf", "https://e.example/category/acts", "https://e.example/acts/12", "https://e.example/x?page=3", "https://e.example/gallery/1", "https://e.example/", "https://e.example/a/.htaccess", "https://e.example/index.php",
    "https://e.example/1/2/3/4/5/6/7/8/9/10/11/12/13/14/15/16",
]
URL_WANT = [
    ("https://example.gov.example/Notices/2024?a=1&b=2", None, "content_page", 120), ("https://e.example/a/a/a/b", "repeated_segment", "navigation", 100), ("https://e.example/wp-admin/x", "trap_pattern", "navigation", 100), ("https://e.example/list?page=21", "pagination_too_deep", "navigation", 100),
    ("https://e.example/cal?month=2&year=2024", "calendar_combinatorics", "navigation", 100), ("https://e.example/img/logo.PNG", "blocked_extension", "navigation", 100), ("ftp://e.example/x.pdf", "non_http", "document", 130), ("https://e.example/files/act.pdf", None, "document", 130),
    ("https://e.example/category/acts", None, "listing", 110), ("https://e.example/acts/12", None, "content_page", 120), ("https://e.example/x?page=3", None, "listing", 110), ("https://e.example/gallery/1", None, "low_value", 95), ("https://e.example/", None, "navigation", 100), ("https://e.example/a/.htaccess", None, "navigation", 100),
    ("https://e.example/", None, "navigation", 100), ("https://e.example/1/2/3/4/5/6/7/8/9/10/11/12/13/14/15/16", "too_many_segments", "navigation", 100),
]


PAGE = "<html lang=\"ne\"><head><title> A  page </title><script src=x></script></head><body><nav><a href='/home'>Home</a></nav><main><h1>Notice</h1><p>" + "Bring the form to the office before noon. " * 4 + "</p><a href=\"/b.pdf\">b</a><a href='/a'>a</a></main><footer>foot</footer></body></html>"
