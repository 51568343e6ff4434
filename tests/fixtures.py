"""Hand-made HTML pages and rows (the driver's tables have no <table>/<option>)."""


def listing_row(address, price="1,250", parking=False, icon="bt06_br", type_text="",
                target="房地(土地+建物)", hidden=" 車位", note="", n=19):
    cells = [f" {address} ", "　社區Ａ　", price + ('<span class="btP_br"></span>' if parking else ""),
             "114/07/15", "123,456", "３０.５", "60%",
             (f'<span class="{icon}"></span>' if icon else "") + type_text, "10", "5/12", "住家用",
             f'{target}<span style="display:none">{hidden}</span>', "3房2廳", "", "有", "有",
             "x", "y", note]
    tds = "".join(f"<td>{c}</td>" for c in cells[:n])
    return f"<tr>{tds}</tr>"


def listing_page(rows):
    return ("<html><body><div id='price_table_info'>查詢結果：" + str(len(rows)) + " 筆</div>"
            "<table><thead><tr><th>地址</th></tr></thead>"
            "<tbody id='table-item-tbody'>" + "".join(rows) + "</tbody></table></body></html>")


def migration_page(rows):
    body = "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in rows)
    return ("<table id='datatable'><thead><tr><th>區域</th><th>男</th><th>女</th></tr></thead>"
            f"<tbody>{body}</tbody></table>")


def options_page(cities):
    return "<select id='p_city'>" + "".join(f"<option>{c}</option>" for c in cities) + "</select>"
