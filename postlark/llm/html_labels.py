"""A few invented pages and the blocks that make up their articles: the labelled table of the block classifier."""

LABELLED_PAGES: tuple[tuple[str, frozenset[str]], ...] = (
    ("""<body><header><a href="/">Harbour Gazette</a><p>News since 1911</p></header>
<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">Local</a></li><li><a href="/c">Weather and tides</a></li></ul></nav>
<div class="ad">Buy one kettle and get a second kettle for half the price this week only.</div>
<article><h1>Ferry returns after repairs</h1><p>The ferry sailed again on Monday after nine weeks in the yard, to the relief
of islanders who had relied on a fishing boat for their post.</p><p>It was full.</p><p>Tickets are sold at
<a href="/pier">the pier office</a> from seven in the morning until the last sailing.</p><p>Yes.</p></article>
<section class="comments"><h3>Comments</h3><p>I waited two hours on the pier and nobody told us anything about the delay.</p>
<p>Great!</p></section><footer>&copy; Harbour Gazette. All rights reserved.</footer></body>""",
     frozenset({"Ferry returns after repairs", "The ferry sailed again on Monday after nine weeks in the yard, to the relief of islanders who "
                "had relied on a fishing boat for their post.", "It was full.",
                "Tickets are sold at the pier office from seven in the morning until the last sailing.", "Yes."})),
    ("""<body><div id="menu"><a href="/1">Start</a> <a href="/2">Recipes</a> <a href="/3">About us</a></div>
<div class="cookie-notice"><p>We use cookies to make this site work and to count our visitors; by reading on you agree to this use.</p>
<button>Accept</button></div><main><h1>Barley soup</h1><h2>You need</h2><ul><li>Barley</li><li>Two leeks</li>
<li>A litre of good stock, made the day before and kept cold</li></ul><h2>Method</h2><p>Wash the barley until the water runs clear, then
simmer it in the stock for an hour with the lid half on.</p><p>Serve hot.</p></main><aside><h3>Popular now</h3><ul><li><a href="/x">Rye bread</a></li>
<li><a href="/y">Plum cake with cream</a></li></ul><p>Our cook answers letters every second Friday of the month in this column.</p></aside>
<form><label>Your e-mail address</label><p>Sign up and we will send you a new recipe every week, free of charge.</p></form></body>""",
     frozenset({"Barley soup", "You need", "Barley", "Two leeks", "A litre of good stock, made the day before and kept cold", "Method",
                "Wash the barley until the water runs clear, then simmer it in the stock for an hour with the lid half on.", "Serve hot."})),
    ("""<body><p><a href="/">Home</a> | <a href="/blog">Blog</a> | <a href="/contact">Contact</a></p><h1>Why I walk to work</h1>
<p>Every morning I leave at seven and take the long way by the canal, where the herons stand and wait for the water to warm.</p>
<p>It takes forty minutes, which is ten more than the bus, but I arrive awake and with the first page of the day already written in my head.</p>
<p>Last winter the towpath was closed for a month and I found out how much I had come to need those forty minutes of quiet each day.</p>
<p><a href="/p1">Older post</a> <a href="/p3">Newer post</a></p><p>Copyright 2019</p></body>""",
     frozenset({"Why I walk to work", "Every morning I leave at seven and take the long way by the canal, where the herons stand and wait for the "
                "water to warm.", "It takes forty minutes, which is ten more than the bus, but I arrive awake and with the first page of the day "
                "already written in my head.", "Last winter the towpath was closed for a month and I found out how much I had come to need those "
                "forty minutes of quiet each day."})),
    ("""<body><div class="sidebar"><h4>Archive</h4><ul><li><a href="/m1">March</a></li><li><a href="/m2">April</a></li></ul>
<p>This journal is written by three friends who met in a lighthouse and never quite left the coast again.</p></div>
<div class="post-content"><h2>Storm notes</h2><p>Wind from the west, gusting to ninety.</p><p>The glass fell all night. By four the sea
was over the wall and into the lower garden, and we carried the hens up to the attic in a laundry basket, one by one.</p><blockquote>Never trust a
quiet dusk.</blockquote><p>We lost the gate.</p><div class="share"><a href="/f">Share</a> <a href="/t">Send</a></div>
<p>The hens are well.</p></div><div class="related"><h3>Read next</h3><p>How we built the wall, and why the sea took it twice before it stood.</p>
</div><div id="footer">Made by the sea</div></body>""",
     frozenset({"Storm notes", "Wind from the west, gusting to ninety.", "The glass fell all night. By four the sea was over the wall and into the "
                "lower garden, and we carried the hens up to the attic in a laundry basket, one by one.", "Never trust a quiet dusk.",
                "We lost the gate.", "The hens are well."})),
    ("""<body><nav><a href="/n1">Sport</a><a href="/n2">Culture</a></nav><article><h1>Cup final ends level</h1><p>Neither side could find
a goal in two hours of rain.</p><div class="advert"><p>New boots for the new season, now at the shop by the station and online at low prices.</p></div>
<p>The replay is on Saturday.</p><p><a href="/fixtures">See all fixtures and results of the season</a></p><table><tr><td>Shots</td><td>4</td></tr>
<tr><td>Corners</td><td>11</td></tr></table><p>Nobody was hurt.</p></article><div class="comment"><p>The referee should have stopped it after
the first half, the pitch was a lake.</p></div><div class="comment"><p>Fair result.</p></div><footer><p>Published by the Evening Post</p><p>
<a href="/imprint">Imprint</a></p></footer></body>""",
     frozenset({"Cup final ends level", "Neither side could find a goal in two hours of rain.", "The replay is on Saturday.",
                "See all fixtures and results of the season", "Shots", "4", "Corners", "11", "Nobody was hurt."})),
    ("""<body><div class="notice">The shop is closed on Sunday and on the Monday that follows it.</div><ul class="menu"><li>Shoes</li><li>Hats</li></ul>
<main><article><h1>Winter hats</h1><p>Felt.</p><p>Wool from the hill farms is washed, carded and pressed by hand; a hat takes two days and lasts for
twenty years if the moths are kept away.</p><p>Blue or green.</p></article></main><p class="disclaimer">Colours on the screen may differ from those
of the goods, and prices may change without notice.</p></body>""",
     frozenset({"Winter hats", "Felt.", "Wool from the hill farms is washed, carded and pressed by hand; a hat takes two days and lasts for twenty "
                "years if the moths are kept away.", "Blue or green."})),
    ("""<body><table><tr><td><a href="/i">Index</a></td><td><a href="/s">Search</a></td></tr></table><h2>Chapter four</h2>
<p>The carriage stopped before the inn and nobody got out, although the landlord came to the door with a lamp and called twice into the dark.</p>
<p>At last a small hand in a grey glove was laid upon the window, and the horses, as if that were a sign, went on by themselves.</p>
<p>&quot;Drive!&quot; said a voice from the box, and there was nobody on the box, and the lamp went out in the landlord's hand.</p>
<p><a href="/c3">Previous</a> <a href="/c5">Next</a></p><p>Page 4 of 20</p></body>""",
     frozenset({"Chapter four", "The carriage stopped before the inn and nobody got out, although the landlord came to the door with a lamp and "
                "called twice into the dark.", "At last a small hand in a grey glove was laid upon the window, and the horses, as if that were a "
                "sign, went on by themselves.", "\"Drive!\" said a voice from the box, and there was nobody on the box, and the lamp went out in "
                "the landlord's hand."})),
    ("""<body><header><h1>City Library</h1><p>Open every day but Friday, from nine until the lamps are lit.</p></header><article><h1>New reading room</h1>
<p>Oak.</p><p>Sixty seats by the north windows, and <a href="/map">a map</a> to find them.</p><ul><li>Quiet</li><li><a href="/rules">House rules for
readers</a></li></ul><p>Come.</p></article><div class="newsletter"><p>Hear of new books first: leave your address and we will write to you once a month.</p>
</div><div role="complementary"><p>Volunteers are wanted for the children's hour on Wednesday afternoon.</p></div><footer><ul><li>Rules</li>
<li><a href="/p">Privacy</a></li></ul></footer></body>""",
     frozenset({"New reading room", "Oak.", "Sixty seats by the north windows, and a map to find them.", "Quiet", "House rules for readers", "Come."})),
    ("""<html><head><title>Snow</title></head><body><nav><a href="/">Front page</a><a href="/w">Weather</a></nav><article><h1>Snow on the pass</h1>
<p>The road is shut above the mill.</p><p>Ploughs set out at dawn and had cleared four of the nine kilometres by noon, the road office says.</p>
<p>Chains are""", frozenset({"Snow on the pass", "The road is shut above the mill.", "Ploughs set out at dawn and had cleared four of the nine "
                             "kilometres by noon, the road office says.", "Chains are"})),
    ("""<body><div class="banner">Spring sale: every seed packet at half price until the end of the month, in all our shops.</div>
<p><a href="/">All letters</a></p><p>Dear neighbours, the well behind the chapel has been cleaned, and the water was tested on Tuesday by the county.</p>
<p>It is good to drink, as it has been these two hundred years, and whoever wants some may come with a bucket at any hour of the day.</p>""",
     frozenset({"Dear neighbours, the well behind the chapel has been cleaned, and the water was tested on Tuesday by the county.",
                "It is good to drink, as it has been these two hundred years, and whoever wants some may come with a bucket at any hour of the "
                "day."})),
    ("""<body><main><h1>Opening hours</h1><p>Nine to five.</p><p>Closed on Mondays.</p></main></body>""",
     frozenset({"Opening hours", "Nine to five.", "Closed on Mondays."})),
    ("""<body><p>Welcome</p><p><a href="/x">Enter</a></p><p>Best viewed at night</p></body>""", frozenset()),
    ("""<body><nav><a href="/">Top</a></nav><div class="ad">Cheaper lamps.</div><article><p>The lamp maker of the lower town has closed his shop after
sixty years, and with it goes the last hand that could mend the old harbour lights when the storms put them out.</p><p>He is ninety.</p>
<div class="promo">More light for less.</div><p>His tools go to the museum, where they will be shown beside the first lamp that his grandfather made for
the pier, once the roof of the east wing has been repaired.</p></article></body>""",
     frozenset({"The lamp maker of the lower town has closed his shop after sixty years, and with it goes the last hand that could mend the old "
                "harbour lights when the storms put them out.", "He is ninety.", "His tools go to the museum, where they will be shown beside the "
                "first lamp that his grandfather made for the pier, once the roof of the east wing has been repaired."})),
    ("""<body><div class="notice">New address.</div><p>We have moved across the square to the house with the green door, where there is room for the
loom and for two more apprentices, and light from the north all day.</p><aside><p>Looms wanted.</p></aside><p>The old shop stays open on market days until
the end of the summer, so that nobody who comes down from the hills has to carry their wool back home again.</p><footer><p>Weavers' guild.</p></footer>
<p class="legal">No part of this page may be copied, sold or hung on a wall without the written leave of the guild and of all its living members.</p></body>""",
     frozenset({"We have moved across the square to the house with the green door, where there is room for the loom and for two more apprentices, "
                "and light from the north all day.", "The old shop stays open on market days until the end of the summer, so that nobody who "
                "comes down from the hills has to carry their wool back home again."})),
    ("""<body><article><h1>Tides</h1><p><a href="/t">Tide tables for the whole coast</a></p><p>Safe home.</p></article></body>""",
     frozenset({"Tides", "Tide tables for the whole coast", "Safe home."})),
    ("""<body><main><h2>Luggage</h2><ul><li><a href="/l1">Boots</a></li><li><a href="/l2">Oilskins and gloves</a></li></ul><p>Rope.</p></main></body>""",
     frozenset({"Luggage", "Boots", "Oilskins and gloves", "Rope."})),
    ("""<body><p><a href="/m">Ten things about the moon that nobody told you at school or since</a></p><p>At the river mouth the tide turns twice a day,
and twice a day the whole bay holds its breath for as long as it takes to drink a glass of water.</p><p><a href="/r">What the spring tide does to
a river mouth and to those who live by it</a> <a href="/s">Seven walks along the bay for the short days of the year</a></p><p>Those who fish there know the
hour by the colour of the mud and need no clock, though most of them carry one.</p></body>""",
     frozenset({"At the river mouth the tide turns twice a day, and twice a day the whole bay holds its breath for as long as it takes to drink a "
                "glass of water.", "Those who fish there know the hour by the colour of the mud and need no clock, though most of them carry one."})),
    ("""<body class="single has-sidebar"><nav><a href="/">Blog</a></nav><article id="post-7" class="post hentry category-legal tag-social-media comments-open">
<h1>A lease in one page</h1><div class="entry-content"><p>The landlord wrote it by hand on the back of a tide table, and in nine years neither of us
found a case that it did not cover.</p><p>Rent on Fridays.</p></div></article><section class="comments-area"><article class="comment-body"><p>Mine has
forty pages and says nothing at all about the roof, which is the only thing that ever breaks.</p></article></section></body>""",
     frozenset({"A lease in one page", "The landlord wrote it by hand on the back of a tide table, and in nine years neither of us found a case "
                "that it did not cover.", "Rent on Fridays."})),
    ("""<body><div class="menu"><a href="/">Mill</a></div><div class="content with-sidebar"><h1>Flour again</h1><p>The stones were dressed in March
and the first sacks of the year went down the hill on Thursday behind the grey mare.</p><p>Rye follows.</p></div><div class="sidebar"><p>Open to visitors on
the last Sunday of every month from ten until the wheel stops.</p></div></body>""",
     frozenset({"Flour again", "The stones were dressed in March and the first sacks of the year went down the hill on Thursday behind the grey "
                "mare.", "Rye follows."})),
    ("""<body><h1>The mill pond</h1><p>The pond was dug by hand in a single dry summer and has never failed since, not even in the year of the
long drought.</p><p>It is deep.</p><p><a href="/ponds">All ponds</a> <a href="/mills">All mills</a></p><p>Printed in Lowtown</p></body>""",
     frozenset({"The mill pond", "The pond was dug by hand in a single dry summer and has never failed since, not even in the year of the long "
                "drought.", "It is deep."})),
    ("""<body><p><a href="/">Home</a></p><p>Letters</p><p>We had the roof off in April and found a nest of owls under the ridge, so the work had to wait
until they were fledged.</p><p>Nobody minded.</p><p>By the time the last of them had left in July the timber was dry, and the slates went back on in nine
days without a drop of rain.</p><p>All is well.</p></body>""",
     frozenset({"We had the roof off in April and found a nest of owls under the ridge, so the work had to wait until they were fledged.",
                "Nobody minded.", "By the time the last of them had left in July the timber was dry, and the slates went back on in nine days "
                "without a drop of rain.", "All is well."})),
    ("""<body><div><a href="/1">North</a> <a href="/2">South</a></div><div>The bridge carries one cart at a time, and the keeper rings a bell when a second
comes up the hill behind it.</div><div>He is never late.</div><div>In the evening he walks across with a lantern and counts the planks, as his father did and
his father before him.</div><div>There are ninety.</div><div><a href="/3">Next bridge</a></div><div>Map</div></body>""",
     frozenset({"The bridge carries one cart at a time, and the keeper rings a bell when a second comes up the hill behind it.", "He is never late.",
                "In the evening he walks across with a lantern and counts the planks, as his father did and his father before him.",
                "There are ninety."})),
    ("""<article><p>The ferry is late.</p></article>""", frozenset({"The ferry is late."})),
    ("""<body><main><p>Yes</p><p>It holds.</p></main></body>""", frozenset({"Yes", "It holds."})),
    ("""<body><article><h1>No</h1></article></body>""", frozenset({"No"})),
    ("""<body><main><ul><li><a href="/a">Oats</a></li><li><a href="/b">Rye</a></li></ul></main></body>""", frozenset({"Oats", "Rye"})),
    ("""<body><p>Moved</p></body>""", frozenset()),
    ("""<body><p>Welcome</p><p>Bienvenue</p><p>Please choose a language</p></body>""", frozenset()),
)
