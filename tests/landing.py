"""Hand-made landing folders."""

import pathlib

from daybook.plans.workspace import Workspace
from tests.conftest import ITEMS, ORDERS, PRODUCTS


def put(workspace: Workspace, name: str, content: str | bytes) -> pathlib.Path:
    path = pathlib.Path(workspace.root) / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content if isinstance(content, bytes) else content.lstrip("\n").encode())
    return path


def golden_workspace(root) -> Workspace:
    workspace = Workspace(str(root))
    put(workspace, "incoming/orders/batch1.csv", ORDERS)
    put(workspace, "incoming/order_items/batch1.csv", ITEMS)
    put(workspace, "static/products_2025-07-01.csv", "id,category\n100,Old\n101,Old\n")
    put(workspace, "static/products_2025-07-02.csv", PRODUCTS)
    return workspace
