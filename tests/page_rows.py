"""Small crawl results shared by the streaming tests."""

PAGES_DDL = "isbn string, url string, page_title string, html string, pos int"


def page_rows(n):
    """Titles repeat every seventh page; some pages are blocked, unrated or not found."""
    rows = []
    for i in range(n):
        rating = "" if i % 5 == 4 else '<div class="RatingStatistics__rating">4.0</div>'
        url = "/search" if i % 11 == 3 else f"/book/show/{i}"
        html = "403 Forbidden" if i % 22 == 3 else f"<h1> Title {i % 7}</h1>{rating}"
        rows.append((str(i), url, f"Title {i % 7}", html, i))
    return rows
