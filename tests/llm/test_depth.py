"""Pages whose elements are nested very deeply."""

import pytest

from riskframe.llm.rendering import render


@pytest.mark.parametrize("depth", [10, 300, 50_000])
@pytest.mark.parametrize("tag", ["font", "div", "b"])
def test_depth_changes_nothing(depth, tag):
    inner = (
        "one <script>var a = '<p>no</p>';</script><style>b {}</style><template>no</template><noscript>no</noscript>"
        "<span hidden>no <i>no</i></span><p style='display:none'>no</p>two<ol><li>x<li>y</ol>"
        "<table><tr><td>a<td>b<tr><td>ccc<td>d</table>three"
    )
    want = render(f"<body>{inner}")[1]
    assert "no" not in want and "var" not in want and "1. x" in want
    assert render(f"<body>{f'<{tag}>' * depth}{inner}")[1] == want
    assert render(f"<body>{f'<{tag}>' * depth}{inner}{f'</{tag}>' * depth}")[1] == want


def test_end_tags_close_their_own_element_at_depth():
    page = "<body>" + "<b>" * 300 + "<div hidden>no<div>no</div>no</div>seen"
    assert render(page)[1] == "seen"
