"""A small labelled table: invented page fragments and whether each belongs to the main text (1) or not (0)."""

from __future__ import annotations

# Each page is a list of (label, fragment); fragments follow each other in the page.
PAGES = [
    [
        (0, "<nav><ul><li><a href=/>Home</a></li><li><a href=/news>News</a></li><li><a href=/faq>Help and contact</a></li></ul></nav>"),
        (0, "<div class='ad'>Buy two lamps today and pay for one.</div>"),
        (1, "<article><h1>The river rose again</h1>"),
        (1, "<p>After three days of rain the river rose above the old bridge and closed the lower road to the mill.</p>"),
        (1, "<p>Nobody was hurt.</p>"),
        (1, "<p>The council says that <a href=/dam>the dam</a> held and that the water will fall by the end of the week, as it did in the spring.</p></article>"),
        (0, "<footer>&copy; valley.example &middot; All rights are reserved by the owners of the valley paper.</footer>"),
    ],
    [
        (0, "<header><div id=logo>Garden notes</div><div class='menu'><a href=/a>Plants</a> <a href=/b>Tools</a></div></header>"),
        (1, "<main><h2>How to prune a pear tree</h2>"),
        (1, "<p>Wait for a dry day in late winter. Cut above a bud that looks outward, and take no more than a third of the young wood.</p>"),
        (1, "<ul><li>a sharp saw</li>"),
        (1, "<li>a ladder with wide feet</li></ul>"),
        (1, "<blockquote>A tree forgives a late cut, not a blunt one.</blockquote></main>"),
        (0, "<aside class='sidebar'><h3>Most read</h3><p>Ten roses for shady walls that flower until the frost comes in autumn.</p></aside>"),
        (0, "<form><label>Your mail</label><p>Send me the letter every month and tell me about new offers.</p></form>"),
        (0, "<footer><a href=/imprint>Imprint</a> <a href=/privacy>Privacy</a></footer>"),
    ],
    [
        (0, "<div class='cookie-notice'>We use cookies to make this site better for you and for our partners. You can change this at any time.</div>"),
        (0, "<div id='navigation'><a href=/1>One</a> | <a href=/2>Two</a> | <a href=/3>Three</a></div>"),
        (1, "<div class='content'><h1>Bread without kneading</h1>"),
        (1, "<div>Mix flour, water, salt and a little yeast in the evening, cover the bowl and leave it until the morning.</div>"),
        (1, "<div>Bake it hot.</div>"),
        (1, "<pre>500 g flour 380 g water 10 g salt</pre></div>"),
        (0, "<section class='comments'><h3>Comments</h3><p>I tried this on Sunday with rye flour and it came out very well, thank you for the recipe.</p><p>Too wet for me.</p></section>"),
        (0, "<div class='related'><a href=/rye>Rye bread for beginners</a><a href=/oat>Oat rolls with seeds</a></div>"),
    ],
    [
        (0, "<p><a href=/x>Start</a> <a href=/y>Archive</a> <a href=/z>About us</a></p>"),
        (1, "<h1>A short history of the town clock</h1>"),
        (1, "<p>The clock was built by two brothers who had never seen one, and it ran backward for its first year.</p>"),
        (1, "<p>Then it stopped.</p>"),
        (1, "<table><tr><td>first repair, paid by the guild of bakers</td>"),
        (1, "<td>second repair, paid by nobody</td></tr></table>"),
        (1, "<p>Since the war it has been kept by the school, whose pupils climb the tower every Friday to wind it by hand.</p>"),
        (0, "<p><a href=/prev>Older story</a> <a href=/next>Newer story</a></p>"),
        (0, "<div class='banner promo'>Half price on all clocks and watches in the shop until Sunday evening only.</div>"),
        (0, "<div class='footer'>Printed in the town, written by its people, read by whoever wants to know more.</div>"),
    ],
    [
        (0, "<div class='site-header'><a href=/>Field and fen</a></div>"),
        (1, "<div class='layout has-sidebar'><div class='overflow-hidden' style='overflow:hidden' aria-hidden=false data-hidden=false><article class='post category-legal'><h1>What the fen remembers</h1>"),
        (1, "<p>Peat keeps leaves, boats and letters, and those who cut it find <a href=/hidden-gems>hidden gems</a> in it every summer.</p>"),
        (1, "<h2 id='related-work'>Earlier digs</h2><p>Two villages dug here before the war and left their spades.</p>"),
        (1, "<section id=discussion><h2>Discussion</h2><p>Whether the boat was sunk on purpose cannot be told from the wood alone.</p></section></article></div>"),
        (0, "<div class='main-sidebar'>Every week a new walk through the fen, told by those who live there.</div></div>"),
        (0, "<p hidden>Only machines are meant to read this line about the fen and the boats in it.</p>"),
        (0, "<div class='site-footer'>Written by the walkers of the fen for whoever walks there next.</div>"),
    ],
]
