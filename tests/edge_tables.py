"""Hand-written edge tables shared by the core tests (imported by name; never from a conftest)."""

EDGE_DDL = "shape_id string, part int, ring int, seq int, x1 double, y1 double, x2 double, y2 double"


def square_edges(shape_id, x0, y0, x1, y1, part=0, ring=0):
    x0, y0, x1, y1 = float(x0), float(y0), float(x1), float(y1)
    pts = [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]
    return [(shape_id, part, ring, i, *a, *b) for i, (a, b) in enumerate(zip(pts, pts[1:] + pts[:1]))]
