"""Small HTML pages of our own in the news-site markup (FIXTURES.md cases)."""

LIST_COMMON = """<html><body><div id="content"><ul id="articleItems">
<li><div class="media-block">
  <a href="/a/one.html">One</a>
  <div class="img-wrap thumb"><img data-src="https://img.example.org/1.jpg" src="https://img.example.org/1s.jpg"></div>
  <div class="media-block__content"><span class="date">2024-01-30 10:00</span></div>
</div></li>
<li><div class="media-block">
  <a href="/a/two.html">Two</a>
  <div class="thumb"><img src="https://img.example.org/2.png"></div>
  <div class="media-block__content"><span class="date">2024-01-30 09:00</span><span class="ico ico--media-type"></span></div>
</div></li>
<li><div class="media-block">
  <div class="thumb"><img src="x.jpg"></div>
  <div class="media-block__content"><span class="date">2024-01-30 08:00</span></div>
</div></li>
<li><div class="media-block">
  <a href="//other.example.org/a/old.html">Old</a>
  <div class="media-block__content"><span class="date">2024-01-01 08:00</span></div>
</div></li>
<li><div class="media-block">
  <a href="/a/after-old.html">After old</a>
  <div class="media-block__content"><span class="date">2024-01-30 07:00</span></div>
</div></li>
</ul>
<ul><li><div class="media-block-x"><a href="/not/entry">no</a></div></li></ul>
</div></body></html>"""

LIST_ASYNC = """<html><body><ol><li><div class="media-block"><a href="p3">Rel</a>
<div class="media-block__content"><span class="date">Jan 5, 2024</span></div></div></li></ol></body></html>"""

LIST_ERROR = "<html><body><p>Nothing here</p></body></html>"

DETAIL = """<html><head><script>var x = "</p>";</script></head><body>
<div id="content">
 <div class="hdr-container">
  <div class="col-title"><h1 class="title pg-title">  A Title &amp; More  </h1></div>
  <div class="published"><span class="date"><time datetime="2024-01-30T08:15:00+05:00">January 30</time></span></div>
  <div class="cover-media"><figure class="media-image"><div><img src=" https://img.example.org/cover.jpg " alt=" Cover "></div></figure></div>
  <div class="col-category"><div class="category"><a href="/c">  Science  </a></div></div>
 </div>
 <div class="body-container">
  <div class="media-pholder media-pholder--audio"><div class="media-download"><div class="inner"><ul>
    <li class="subitem"><a href="https://a.example.org/hi.mp3">128 kbps | MP3</a></li>
    <li class="subitem"><a href="https://a.example.org/lo.mp3">64 KBPS | MP3</a></li>
    <li class="subitem"><a href="https://a.example.org/lo2.mp3">64 kbps | MP3</a></li>
  </ul></div></div></div>
  <div id="article-content"><div class="wsw">
loose text
<!-- a comment -->
<div class="media-pholder"><p>audio player</p></div>
<div><div class="media-pholder">player</div></div>
<div><div class="quiz">Quiz</div></div>
<div class="wrap"><figure class="media-image"><div class="thumb"><img src="https://img.example.org/Pic.JPG?x=1" alt=" First image "></div></figure></div>
<p>First paragraph.</p>
<p>___________</p>
<p>__________</p>
<p>Second <em>paragraph</em> here.</p>
<div><iframe src="https://v.example.org"></iframe></div>
<div class="wrap"><figure class="media-image"><div class="thumb"><img src="https://img.example.org/noext" alt=""></div></figure></div>
<p>I'm Jane Doe.</p>
<p><em>Edited by Someone.</em></p>
<p>   </p>
<p>Not <em>all</em> emphasis.</p>
<h2>Words in this Story</h2>
<p><strong>word</strong> - a meaning</p>
<ul><li>kept list</li></ul>
</div></div>
 </div>
</div></body></html>"""
