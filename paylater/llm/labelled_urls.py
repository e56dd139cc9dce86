"""A small table of URLs labelled by hand: what a crawl for training texts should leave out (1) or keep (0).

Left out are gambling, adult pages, pill and replica shops, loan and prize scams, download traps,
link farms, and servers of advertisements and trackers.  The hosts are invented.
"""

from __future__ import annotations

# Labels given by hand.
BLOCKED = """
https://www.royal-casino-bonus.com/slots/play?id=7
http://casino-jackpot.net/en/register
https://m.casino24.org/de/bonus.html
http://online-casinos.info/fr/12
https://best-poker-rooms.com/holdem/3812
http://pokerstake.net/en/cash-games
https://www.lucky-slots.biz/spin/
https://slotmachine-free.com/de/442.html
http://betting-tips.net/football/today
https://www.betsnow.com/live/9331
http://sports-bets.org/en/odds
https://mybetz.net/fr/paris/88
https://blackjack-winner.com/win/now
http://www.winbig-lotto.com/en/claim
https://bingo-winners.net/rooms/5
http://adult-videos.net/watch/8841
https://www.adultchat.org/en/cams
http://blog.xxx-pics.com/gallery/17.html
https://free-xxx.net/de/tube
http://hot-sex-dates.com/en/join
https://www.sexcams.biz/live/2201
http://porn-hd.net/video/993
https://m.pornclips.org/fr/1184
http://nude-girls.info/pics/33.html
https://escort-service.biz/en/city
http://cheap-viagra.com/buy/100mg
https://www.cialis-cheap.net/order.html
http://pills-online.biz/en/shop
https://buy-pills-now.com/de/rx/221
http://diet-pills-best.net/offer
https://www.discount-pharmacy-rx.com/no-prescription/
http://cheapmeds.info/en/tramadol
https://steroids-shop.biz/fr/order/8
http://replica-watches.net/rolex/cheap
https://www.cheap-handbags-outlet.com/en/sale/44
http://cheap-sneakers-sale.biz/de/9
https://payday-loans-fast.com/apply
http://www.instant-loan-cash.net/en/apply.html
https://quick-cash-credit.biz/fr/go
http://free-iphone-winner.com/claim/7712
https://www.prize-claim.net/en/you-won
http://freegiftcards.biz/de/survey
https://free-money-now.info/join/3
http://get-rich-crypto.com/en/double
https://bitcoin-doubler.net/invest/8
http://forex-profits.biz/fr/signals
https://www.miracle-cure.info/en/buy
http://crack-keygen.net/download/811
https://warez-downloads.org/en/serial.html
http://free-mp3-downloads.biz/get/55
https://torrent-crack.com/de/setup.exe
http://driver-update-scan.net/en/install.exe
https://secure-login-verify.info/account/confirm
http://bank-verify-account.biz/en/login.php
http://linkfarm.net/out/8832
https://www.link-exchange-seo.com/directory/41
http://seo-backlinks.biz/en/buy
https://spamlinks.org/fr/list/7
http://www.spam-blog.net/en/5512
https://spamsite.info/de/88.html
http://content-farm.biz/articles/99381
https://article-spinner.net/en/441
http://doorway-pages.info/k/13
http://ads.banner-network.com/click?c=1
https://ads-server.net/serve/9912
http://m.adserve.org/en/pop
https://ad-clicks.biz/redirect/22
http://track.clickstat.net/pixel.gif
https://tracker-pixel.com/t/8810
http://www.click-tracking.org/en/r/77
https://popunder-ads.net/fr/go/1
http://banner-ads.info/de/411
https://affiliate-track.biz/en/r?id=3
http://toolbar-install.com/en/adware
""".split()

KEPT = """
https://www.city-library.org/catalogue/7712
http://news.morningpost.com/world/2021/03/article
https://blog.gardening-notes.net/en/1893
http://www.statemuseum.org/exhibits/22.html
https://history.university.edu/courses/101
http://physics-lectures.net/de/12
https://m.weatherreport.com/fr/paris
http://cooking-at-home.com/recipes/bread.html
https://www.railwayclub.org/en/timetable
http://docs.pythonic.net/tutorial/3
https://wiki.openatlas.org/en/Rivers
http://forum.woodworkers.com/t/8812
https://www.villageschool.net/en/news/44
http://health-institute.org/fr/research/91
https://www.cityhall.net/de/services.html
http://poetry-archive.org/poems/1827
https://journal.biology.net/vol/12/paper/3
http://www.hiking-trails.com/en/alps/55
https://birdwatching.org/species/442
http://blog.travelnotes.net/en/2993
https://m.localpaper.com/en/8127
http://www.townhistory.org/de/1881
https://chess-club.net/games/90
http://oldmaps.org/fr/sheet/17
https://www.theatre-season.com/en/programme
http://therapy-research.org/en/421
https://blog.thesisnotes.net/en/3318
http://www.thornhill-school.org/de/5
https://m.theheron.com/en/7741
http://tinsmith-guild.net/fr/228
https://www.thinkers-forum.org/en/1039
http://blog.tithebarn.net/de/6120
https://thenews.net/en/4471
http://m.thistle.org/fr/9120
https://theland.com/en/201
http://www.themill.net/de/77
https://tides-and-tables.org/en/3
http://anthology.net/en/188
https://www.enriched-soil.org/en/5220
http://restoration-works.com/fr/14
https://blog.lantern.net/de/3160
http://m.harbour.org/en/6021.html
https://www.station-master.com/en/40
http://ironbridge.net/fr/8110
https://orchestra.org/de/concerts/9
http://software-guide.net/en/manual/12
https://www.linguistics.org/papers/77
http://blog.mathematics.net/en/primes
https://m.football-league.com/en/results
http://www.trackandfield.org/en/records
https://railway-tracks.net/de/history/3
http://addresses.cityarchive.org/en/17
https://www.adelaide-herald.com/en/5001
http://farm-shop.net/en/apples
https://www.farmersweekly.com/de/112
http://bettertomorrow.org/fr/essay/2
https://alphabet-books.com/en/letters
http://www.winter-sports.org/en/ski
https://windmills.net/de/4
http://essex-county.org/en/parks
https://www.middlesex-college.edu/en/admissions
http://chemistry-pillars.org/fr/8
https://free-library.net/en/books/31
http://www.freedom-press.org/de/771
https://cheapside-history.org/en/2
http://adulteducation-centre.edu/en/courses
https://www.playground-design.com/fr/5
http://cashmere-weavers.net/de/19
https://blog.seaside-town.org/en/1330
http://parliament-records.net/en/1911
https://www.clockmakers.org/fr/221
http://newsletter.astronomy.com/en/77.html
https://legal-commentary.net/de/981
http://m.grammar-school.org/en/16
""".split()

ROWS = [(url, label) for label, urls in ((1, BLOCKED), (0, KEPT)) for url in urls]
