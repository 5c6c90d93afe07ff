"""Own pages and payloads: a tea shop."""

PRODUCT_URL = "https://tea.example/oolong-tin-i.77.9001"

SAMPLE_PAGE = """<!doctype html><html lang="en"><body>
<h1>Mountain oolong, 200 g tin</h1>
<p>Rolled leaves from a single garden.</p>
<nav><a href='#taste'>Taste</a> <a href='ratings/all'>All ratings</a> <a href='/help'>Help</a>
<a href='?sort=new&amp;page=3'>Older</a></nav>
<script>
window.__INITIAL_STATE__ = {"item": {"sold": 310, "location": "Alishan", "price_min": 5, "price": 48000},
  "seller": {"follower_count": 1200, "shop_name": "Leaf and Kettle"},
  "comments": {"rows": [
    {"content": "Second steep is the best one", "rating_star": 4, "username": "mei", "ctime": 1733011200},
    {"content": "Tin arrived dented, tea is fine", "rating_star": 3, "username": "otto", "videos": ["v1"], "images": ["p", "q", "r"]},
    {"content": "Smells of orchids", "rating_star": 5, "username": "mei", "seller_reply": "We are glad"}]}};
</script>
<script type="application/ld+json">{"@type": "BreadcrumbList", "itemListElement": [{"name": "Drinks"}, {"name": "Tea"}, {"name": "Oolong"}]}</script>
<meta name="description" content="Lightly roasted &lt;oolong&gt;">
<title>Oolong tin | Leaf and Kettle</title>
</body></html>"""

PAYLOAD = """{"page": 4, "reviews": [
 {"review_text": "Too floral for me", "stars": 2},
 {"review_text": "Bought it three times", "score": 5, "author": "ines", "seller_reply": {"by": "shop", "comment": "See you"}},
 {"review_text": "Pleasant", "rating": 4, "images": []}]}"""

RENDERED_CARDS = """<main><section class="note">Nothing here</section>
<div data-testid="product-review">2 bintang. Leaves were broken, 7 January 2025 | variasi: loose leaf | 12 orang terbantu</div>
<div class="buyer rating item">Seller response: sorry! 4/5 fragrant and fresh <img src="1.png"><img src="2.png"><video src="3.mp4"></video></div>
<div class="rating">meh</div></main>"""

SHELL_PAGE = """
<html><head><title>Toko</title><script type="text/plain">{"a": 1}</script></head>
<body><div id="main"></div><script>window.__ASSETS__ = {"x": "y.js"};</script></body></html>
"""
